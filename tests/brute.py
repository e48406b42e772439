"""Brute-force counterparts of the rating recommenders: dense matrices, straight from the formulas."""

import numpy as np


class Dense:
    """A users x items matrix of ratings, NaN where there is none."""

    def __init__(self, rows):
        self.users = sorted({r[0] for r in rows})
        self.items = sorted({r[1] for r in rows})
        self.r = np.full((len(self.users), len(self.items)), np.nan)
        for u, i, rating in rows:
            self.r[self.users.index(u), self.items.index(i)] = rating
        self.rated = ~np.isnan(self.r)
        self.mu = np.nanmean(self.r)

    def offsets(self, user_damp=10, item_damp=25):
        bu = np.nansum(self.r - self.mu, axis=1) / (self.rated.sum(axis=1) + user_damp)
        bi = np.nansum(self.r - bu[:, None] - self.mu, axis=0) / (self.rated.sum(axis=0) + item_damp)
        return bu, bi

    def pearson(self, target):
        """{user: correlation with the target}, weighted by min(shared / 50, 1)."""
        means, t = np.nanmean(self.r, axis=1), self.users.index(target)
        out = {}
        for u, user in enumerate(self.users):
            if u == t:
                continue
            both = self.rated[u] & self.rated[t]
            du, dt = self.r[u, both] - means[u], self.r[t, both] - means[t]
            norm = np.sqrt((du * du).sum()) * np.sqrt((dt * dt).sum())
            flat = any(np.nanmin(self.r[x]) == np.nanmax(self.r[x]) for x in (u, t))
            out[user] = 0.0 if flat or norm == 0 else round(min(both.sum() / 50, 1) * (du * dt).sum() / norm, 12)
        return out

    def neighbours(self, target, k=30):
        return sorted(self.pearson(target).items(), key=lambda e: (-e[1], e[0]))[:k]

    def user_estimates(self, target, k=30):
        """{item: estimate or None} of items that neighbours rated and the target did not."""
        means, t = np.nanmean(self.r, axis=1), self.users.index(target)
        out = {}
        for i, item in enumerate(self.items):
            near = [(p, self.users.index(u)) for u, p in self.neighbours(target, k)]
            near = [(p, u) for p, u in near if self.rated[u, i]]
            if self.rated[t, i] or not near:
                continue
            weight = sum(abs(p) for p, _ in near)
            out[item] = means[t] + sum((self.r[u, i] - means[u]) * p for p, u in near) / weight if weight else None
        return out

    def item_estimates(self, target, positive=False, k=30):
        """{item: estimate} of items that the target did not rate, from the k most similar of all others."""
        bu, bi = self.offsets()
        base = bu[:, None] + bi + self.mu
        left = np.where(self.rated, self.r - base, 0.0)
        norm = np.sqrt((left * left).sum(axis=0))
        with np.errstate(invalid="ignore", divide="ignore"):
            sim = np.round(left.T @ left / np.outer(norm, norm), 12) + 0.0
        t, out = self.users.index(target), {}
        for m in np.flatnonzero(~self.rated[t]):
            others = [j for j in range(len(self.items)) if j != m and not np.isnan(sim[m, j])]
            near = sorted(others, key=lambda j: (-sim[m, j], j))[:k]
            near = [j for j in near if self.rated[t, j] and (sim[m, j] >= 0 or not positive)]
            weight = np.abs(sim[m, near]).sum()
            if weight > 0:
                out[self.items[m]] = base[t, m] + (sim[m, near] * left[t, near]).sum() / weight
        return out


def top(estimates, n=10):
    """Ids of the best estimates, ties by id."""
    known = [(i, v) for i, v in estimates.items() if v is not None]
    return [i for i, _ in sorted(known, key=lambda e: (-round(e[1], 12), e[0]))[:n]]
