"""SQL oracle: for each registered query, an independent DuckDB statement over
the driver's views (region nation customer supplier part orders lineitem ...).

Bindings and intermediate steps are named CTEs; ``sql(deps, body)`` prepends
the CTEs a statement needs, in dependency order.
"""

from __future__ import annotations

# name -> (dependencies, body)
CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTE[name] = (deps, body)


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for dep in CTE[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(deps: tuple[str, ...], body: str) -> str:
    names = _order(deps)
    if not names:
        return body.strip()
    parts = [f"{n} AS (\n{CTE[n][1].strip()}\n)" for n in names]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


ORACLE: dict[str, str] = {}


def _signed_zero_safe(text: str, digits: str = "6") -> str:
    """Wrap every ``round(x, 6)`` as ``(round(x, 6) + 0.0)``: DuckDB keeps -0.0
    after rounding a tiny negative, Spark gives 0.0; adding 0.0 maps -0.0 to 0.0."""
    out, i, key = [], 0, "round("
    while True:
        j = text.find(key, i)
        if j < 0:
            out.append(text[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(text[k], 0)
            if depth == 0:
                break
            k += 1
        call = text[j:k + 1]
        inner = _signed_zero_safe(call[len(key):-1], digits)
        call = key + inner + ")"
        if call.replace(" ", "").endswith(f",{digits})"):
            call = f"({call} + 0.0)"
        out.append(text[i:j])
        out.append(call)
        i = k + 1


def oracle(name: str, deps: tuple[str, ...], body: str) -> None:
    ORACLE[name] = _signed_zero_safe(sql(deps, body))


# -- bindings ------------------------------------------------------------------------

cte("ratings", (), """
SELECT o_custkey AS user_id, l_partkey AS item_id,
       CAST(1 + floor((max(l_quantity) - 1) / 10) AS INTEGER) AS rating
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY 1, 2""")

# -- rating statistics -----------------------------------------------------------------

oracle("ratings_load", ("ratings",), "SELECT user_id, item_id, rating FROM ratings")

oracle("rating_density", ("ratings",), """
SELECT round(count(rating) / count(DISTINCT user_id), 6) AS average_user_ratings,
       round(count(rating) / count(DISTINCT item_id), 6) AS average_film_ratings,
       round(count(rating) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 6) AS completeness
FROM ratings""")

oracle("global_mean", ("ratings",), "SELECT round(avg(rating), 6) AS avg_rating FROM ratings")

oracle("user_means", ("ratings",),
       "SELECT user_id, round(avg(rating), 6) AS avg_rating FROM ratings GROUP BY user_id")

oracle("target_ratings", ("ratings",),
       "SELECT item_id, rating FROM ratings WHERE user_id = 7")

oracle("unwatched_items", ("ratings",), """
SELECT DISTINCT item_id FROM ratings
WHERE item_id NOT IN (SELECT item_id FROM ratings WHERE user_id = 7)""")

oracle("user_rating_maps", ("ratings",), """
SELECT user_id, chunk, n, string_agg(item_id || ':' || rating, ',' ORDER BY item_id, rating) AS ratings
FROM (SELECT user_id, item_id, rating, n,
             ((item_id % 2147483647) * 48271 % 2147483647)
               % greatest(1, CAST(ceil(n / 4096.0) AS BIGINT)) AS chunk
      FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM ratings))
GROUP BY user_id, chunk, n""")

# -- baselines ---------------------------------------------------------------------------

cte("mu", ("ratings",), "SELECT avg(rating) AS mu FROM ratings")
cte("bu", ("ratings", "mu"), """
SELECT user_id, count(item_id) AS n_u,
       sum(rating - (SELECT mu FROM mu)) / (count(item_id) + 10) AS b_u
FROM ratings GROUP BY user_id""")
cte("bi", ("ratings", "mu", "bu"), """
SELECT r.item_id, sum(r.rating - bu.b_u - (SELECT mu FROM mu)) / (count(r.item_id) + 25) AS b_i
FROM ratings r JOIN bu ON r.user_id = bu.user_id GROUP BY r.item_id""")
cte("res", ("ratings", "mu", "bu", "bi"), """
SELECT r.user_id, r.item_id, r.rating,
       r.rating - (bu.b_u + bi.b_i + (SELECT mu FROM mu)) AS residual
FROM ratings r JOIN bu ON r.user_id = bu.user_id JOIN bi ON r.item_id = bi.item_id""")

oracle("user_baseline", ("bu",), "SELECT user_id, round(b_u, 6) AS value FROM bu")
oracle("item_baseline", ("bi",), "SELECT item_id, round(b_i, 6) AS value FROM bi")
oracle("baseline_grid", ("bu", "bi", "mu"), """
SELECT item_id, round((SELECT b_u FROM bu WHERE user_id = 7) + b_i + (SELECT mu FROM mu), 6) AS value
FROM bi""")
cte("cells", (), """
SELECT c_custkey AS user_id, c_custkey AS item_id FROM customer
UNION ALL SELECT c_custkey, -c_nationkey FROM customer
UNION ALL SELECT p_size, p_partkey FROM part""")
oracle("baseline_predict", ("cells", "bu", "bi", "mu"), """
SELECT c.user_id, c.item_id, round(coalesce(bu.b_u, 0.0) + coalesce(bi.b_i, 0.0) + (SELECT mu FROM mu), 6) AS value,
       bu.b_u IS NOT NULL AS known_user, bi.b_i IS NOT NULL AS known_item
FROM cells c LEFT JOIN bu ON bu.user_id = c.user_id LEFT JOIN bi ON bi.item_id = c.item_id""")
oracle("residuals_dense", ("res",),
       "SELECT user_id, item_id, round(residual, 6) AS residual FROM res")

# -- user CF -------------------------------------------------------------------------------

cte("ust", ("ratings",), """
SELECT user_id, count(rating) AS n, avg(rating) AS mean, min(rating) = max(rating) AS flat
FROM ratings GROUP BY user_id""")
cte("tst", ("ust",), "SELECT * FROM ust WHERE user_id = 7")
cte("tmine", ("ratings", "tst"), """
SELECT item_id, rating - (SELECT mean FROM tst) AS dt FROM ratings WHERE user_id = 7""")
cte("shared", ("ratings", "tmine", "ust"), """
SELECT r.user_id, count(*) AS s,
       sum((r.rating - u.mean) * m.dt) AS num,
       sum((r.rating - u.mean) * (r.rating - u.mean)) AS d1,
       sum(m.dt * m.dt) AS d2
FROM ratings r JOIN tmine m ON r.item_id = m.item_id JOIN ust u ON r.user_id = u.user_id
WHERE r.user_id <> 7 GROUP BY r.user_id""")
cte("pcs", ("ust", "shared", "tst"), """
SELECT user_id, mean, round(pc_raw, 12) AS pc, pc_raw FROM (
SELECT u.user_id, u.mean,
       CASE WHEN u.flat OR (SELECT flat FROM tst) OR s.s IS NULL THEN 0.0
            ELSE coalesce((least(s.s / 50.0, 1.0) * s.num) / nullif(sqrt(s.d1) * sqrt(s.d2), 0), 0.0)
       END AS pc_raw
FROM ust u LEFT JOIN shared s ON u.user_id = s.user_id
WHERE u.user_id <> 7)""")
cte("nb", ("pcs",), """
SELECT * FROM (SELECT row_number() OVER (ORDER BY pc DESC, user_id ASC) AS rank, user_id, mean, pc, pc_raw
               FROM pcs) WHERE rank <= 30""")
cte("uest", ("ratings", "nb", "tst"), """
SELECT item_id, (SELECT mean FROM tst) + sum(mark) / nullif(sum(abs(pc)), 0) AS estimate
FROM (SELECT r.item_id, (r.rating - nb.mean) * nb.pc AS mark, nb.pc
      FROM ratings r JOIN nb ON r.user_id = nb.user_id
      WHERE r.item_id NOT IN (SELECT item_id FROM ratings WHERE user_id = 7))
GROUP BY item_id""")
cte("utop", ("uest",), """
SELECT * FROM (SELECT row_number() OVER (ORDER BY round(estimate, 12) DESC, item_id ASC) AS rank,
                      item_id, estimate
               FROM uest WHERE estimate IS NOT NULL) WHERE rank <= 10""")

oracle("pearson_neighbours", ("nb",), "SELECT rank, user_id, round(pc_raw, 6) AS pc FROM nb")
oracle("user_cf_estimates", ("uest",), "SELECT item_id, round(estimate, 6) AS estimate FROM uest")
oracle("user_cf_top10", ("utop",), "SELECT rank, item_id, round(estimate, 6) AS estimate FROM utop")

# -- item CF ----------------------------------------------------------------------------------

cte("norms", ("res",), "SELECT item_id, sum(residual * residual) AS norm2 FROM res GROUP BY item_id")
cte("sims", ("res", "norms", "ratings"), """
SELECT m1, m2, round(sim_raw, 12) AS sim, sim_raw FROM (
SELECT p.m1, p.m2, p.num / nullif(sqrt(n1.norm2) * sqrt(n2.norm2), 0) AS sim_raw
FROM (SELECT a.item_id AS m1, b.item_id AS m2, sum(a.residual * b.residual) AS num
      FROM res a JOIN res b ON a.user_id = b.user_id AND a.item_id <> b.item_id
      WHERE a.item_id NOT IN (SELECT item_id FROM ratings WHERE user_id = 7)
      GROUP BY 1, 2) p
JOIN norms n1 ON n1.item_id = p.m1 JOIN norms n2 ON n2.item_id = p.m2)""")
cte("kept", ("sims", "norms"), """
SELECT m1, m2, sim, sim_raw, rank FROM (
  SELECT r.m1, r.m2, r.sim, r.sim_raw,
         r.rn + CASE WHEN r.sim < 0 THEN z.z ELSE 0 END AS rank
  FROM (SELECT m1, m2, sim, sim_raw, row_number() OVER (PARTITION BY m1 ORDER BY sim DESC, m2 ASC) AS rn
        FROM sims WHERE sim IS NOT NULL) r
  JOIN (SELECT m1, (SELECT count(*) FROM norms WHERE norm2 > 0) - 1 - count(*) AS z
        FROM sims WHERE sim IS NOT NULL GROUP BY m1) z ON r.m1 = z.m1
  WHERE r.rn <= 30)
WHERE rank <= 30 AND sim <> 0""")


def _item_estimates(positive: bool) -> str:
    cond = "AND k.sim >= 0" if positive else ""
    return f"""
SELECT s.m1 AS item_id,
       ((SELECT b_u FROM bu WHERE user_id = 7) + bi.b_i + (SELECT mu FROM mu))
         + s.s_diff / nullif(s.s_abs, 0) AS estimate
FROM (SELECT k.m1, sum(k.sim * m.residual) AS s_diff, sum(abs(k.sim)) AS s_abs
      FROM kept k JOIN res m ON m.user_id = 7 AND m.item_id = k.m2 WHERE 1 = 1 {cond}
      GROUP BY k.m1) s
JOIN bi ON bi.item_id = s.m1"""


cte("iest", ("kept", "res", "bu", "bi", "mu"), _item_estimates(False))
cte("iest_pos", ("kept", "res", "bu", "bi", "mu"), _item_estimates(True))


def _top(src: str) -> str:
    return f"""
SELECT * FROM (SELECT row_number() OVER (ORDER BY round(estimate, 12) DESC, item_id ASC) AS rank,
                      item_id, estimate
               FROM {src} WHERE estimate IS NOT NULL) WHERE rank <= 10"""


cte("itop", ("iest",), _top("iest"))
cte("itop_pos", ("iest_pos",), _top("iest_pos"))

oracle("item_similarity", ("sims",), "SELECT m1, m2, round(sim_raw, 6) AS sim FROM sims")
oracle("item_topk", ("kept",), "SELECT m1, m2, round(sim_raw, 6) AS sim, rank FROM kept")
oracle("item_cf_estimates", ("iest",),
       "SELECT item_id, round(estimate, 6) AS estimate FROM iest WHERE estimate IS NOT NULL")
oracle("item_cf_top10", ("itop",), "SELECT rank, item_id, round(estimate, 6) AS estimate FROM itop")
oracle("item_cf_top10_positive", ("itop_pos",),
       "SELECT rank, item_id, round(estimate, 6) AS estimate FROM itop_pos")


def _half_down(x: str) -> str:
    return (f"CAST(CAST(sign({x}) * (ceil(abs(CAST({x} AS DECIMAL(30,18))) * 10000 - 0.5) / 10000) "
            f"AS DECIMAL(20,4)) AS DOUBLE)")


oracle("cf_report", ("ratings", "mu", "nb", "utop", "itop", "itop_pos"), f"""
SELECT {_half_down("count(rating) / count(DISTINCT user_id)")} AS average_user_ratings,
       {_half_down("count(rating) / count(DISTINCT item_id)")} AS average_film_ratings,
       {_half_down("count(rating) / (count(DISTINCT user_id) * count(DISTINCT item_id))")} AS completeness,
       {_half_down("(SELECT mu FROM mu)")} AS average_rating,
       (SELECT string_agg(user_id, ',' ORDER BY rank) FROM nb) AS pearson_neighbours,
       (SELECT string_agg(item_id, ',' ORDER BY rank) FROM utop) AS pearson_top10,
       (SELECT string_agg(item_id, ',' ORDER BY rank) FROM itop) AS predicators_top10,
       (SELECT string_agg(item_id, ',' ORDER BY rank) FROM itop_pos) AS predicators_positive_top10
FROM ratings""")

# -- click graph -----------------------------------------------------------------------------------

cte("lines", (), """
SELECT l_orderkey AS o, l_partkey AS p, min(l_linenumber) AS ln, sum(l_quantity) AS q
FROM lineitem GROUP BY 1, 2""")
cte("edges", ("lines",), """
SELECT a.p AS item1, b.p AS item2, CAST(sum(b.q) AS BIGINT) AS click
FROM lines a JOIN lines b ON a.o = b.o AND a.p <> b.p AND a.ln < b.ln
GROUP BY 1, 2""")
cte("catalogs", (), """
SELECT p_partkey AS item,
       CASE WHEN p_size <= 47 THEN 10 * CAST(substr(p_brand, 7) AS INTEGER)
         + list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'], p_type) END AS catalog
FROM part""")
cte("brothers", ("catalogs",), """
SELECT DISTINCT c1.catalog, c2.catalog AS brother
FROM catalogs c1 JOIN catalogs c2 ON c1.catalog % 10 = c2.catalog % 10""")
cte("item_ratings", ("ratings",), """
SELECT item_id AS itemid, CASE WHEN item_id % 17 <> 0 THEN round(avg(rating), 6) END AS rating
FROM ratings GROUP BY item_id""")
cte("targets", (), "SELECT p_partkey AS item FROM part WHERE p_partkey % 20 = 0")
cte("items", (), """
SELECT CAST(p_partkey AS VARCHAR) AS itemid,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey // 5 END AS parent_id,
       p_name AS attr1, p_brand AS attr2, p_type AS attr3, 'size ' || p_size AS attr4,
       CASE WHEN p_partkey % 3 = 0 THEN NULL
            ELSE ' Price ' || CAST(floor(p_retailprice) AS INTEGER) END AS attr5
FROM part""")
cte("merged", ("edges", "catalogs", "item_ratings"), """
SELECT e.item1, c1.catalog AS catalog1, r1.rating AS rating1,
       e.item2, c2.catalog AS catalog2, r2.rating AS rating2, e.click
FROM edges e
LEFT JOIN catalogs c1 ON e.item1 = c1.item
LEFT JOIN catalogs c2 ON e.item2 = c2.item
LEFT JOIN item_ratings r1 ON e.item1 = r1.itemid
LEFT JOIN item_ratings r2 ON e.item2 = r2.itemid""")
cte("rev", ("merged",), """
SELECT DISTINCT item2, item1 AS id, coalesce(rating1, 0.0) AS rating,
       coalesce(catalog1, 0) AS catalog, click
FROM merged""")

oracle("edges_explode", ("edges",), "SELECT item1, item2, click FROM edges")
oracle("catalogs_load", ("catalogs",), "SELECT item, CAST(catalog AS DOUBLE) AS catalog FROM catalogs")
oracle("catalog_brothers", ("brothers",), """
SELECT catalog, string_agg(brother, ',' ORDER BY brother) AS brothers
FROM brothers GROUP BY catalog""")
_MERGED_OUT = ("item1, CAST(catalog1 AS DOUBLE) AS catalog1, rating1, "
               "item2, CAST(catalog2 AS DOUBLE) AS catalog2, rating2, click")
oracle("edges_merged", ("merged",), f"SELECT {_MERGED_OUT} FROM merged")
oracle("edges_distinct", ("merged",), "SELECT DISTINCT item1, item2 FROM merged")
oracle("edges_missing_catalog", ("merged",),
       f"SELECT {_MERGED_OUT} FROM merged WHERE catalog1 IS NULL OR catalog2 IS NULL")
oracle("edges_missing_catalog_count", ("merged",),
       "SELECT count(*) AS n_edges FROM merged WHERE catalog1 IS NULL OR catalog2 IS NULL")
oracle("edges_touching_item", ("merged",),
       f"SELECT {_MERGED_OUT} FROM merged WHERE item1 = 7 OR item2 = 7")


def _profile(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS field, count({c}) AS n, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS stddev, min({x}) AS min_value, max({x}) AS max_value "
            f"FROM merged")


oracle("edge_profile", ("merged",),
       "\nUNION ALL\n".join(_profile(c) for c in ("rating1", "rating2", "click")))

oracle("edge_quantiles", ("rev",), """
SELECT (SELECT count(*) FROM rev) AS n_clicks,
       (SELECT click FROM (SELECT click, row_number() OVER (ORDER BY click) - 1 AS i FROM rev)
         WHERE i = (SELECT count(*) FROM rev) // 2) AS click_p50,
       (SELECT click FROM (SELECT click, row_number() OVER (ORDER BY click) - 1 AS i FROM rev)
         WHERE i = (SELECT count(*) FROM rev) // 2 + (SELECT count(*) FROM rev) // 4) AS click_p75,
       (SELECT round(avg(click), 6) FROM rev) AS click_mean,
       (SELECT count(*) FROM rev WHERE rating <> 0) AS n_ratings,
       (SELECT rating FROM (SELECT rating, row_number() OVER (ORDER BY rating) - 1 AS i
                            FROM rev WHERE rating <> 0)
         WHERE i = (SELECT count(*) FROM rev WHERE rating <> 0) // 2) AS rating_p50,
       (SELECT rating FROM (SELECT rating, row_number() OVER (ORDER BY rating) - 1 AS i
                            FROM rev WHERE rating <> 0)
         WHERE i = (SELECT count(*) FROM rev WHERE rating <> 0) // 2
                 + (SELECT count(*) FROM rev WHERE rating <> 0) // 4) AS rating_p75""")

oracle("parents_with_siblings", ("items",), """
SELECT parent_id, count(*) AS n_items FROM items
GROUP BY parent_id HAVING count(parent_id) > 3""")


def _chunk(member: str) -> str:
    return (f"(({member} % 2147483647) * 48271 % 2147483647) "
            f"% greatest(1, CAST(ceil(n / 4096.0) AS BIGINT))")


oracle("adjacency_out", ("merged",), f"""
SELECT item1, chunk, n, string_agg(item2, ',' ORDER BY item2) AS neighbours
FROM (SELECT item1, item2, n, {_chunk("item2")} AS chunk
      FROM (SELECT item1, item2, count(*) OVER (PARTITION BY item1) AS n
            FROM (SELECT DISTINCT item1, item2 FROM merged)))
GROUP BY item1, chunk, n""")

oracle("adjacency_in", ("rev",), f"""
SELECT item2, chunk, n,
       string_agg(id || ':' || rating || ':' || catalog || ':' || click, ','
                  ORDER BY id, rating, catalog, click) AS sources
FROM (SELECT *, {_chunk("id")} AS chunk
      FROM (SELECT *, count(*) OVER (PARTITION BY item2) AS n FROM rev))
GROUP BY item2, chunk, n""")

cte("tcat", ("targets", "catalogs"), """
SELECT t.item, c.catalog FROM targets t JOIN catalogs c ON t.item = c.item
WHERE c.catalog IS NOT NULL""")
cte("allowed", ("tcat", "brothers"), """
SELECT DISTINCT t.item AS target, b.brother AS catalog
FROM tcat t JOIN brothers b ON b.catalog = t.catalog""")
cte("lvl1", ("tcat", "rev", "allowed"), """
SELECT t.item AS target, r.id AS item, r.rating, r.catalog, r.click, 1 AS level
FROM tcat t JOIN rev r ON r.item2 = t.item
JOIN allowed a ON a.target = t.item AND a.catalog = r.catalog
WHERE r.id <> t.item""")
cte("lvl2", ("lvl1", "rev", "allowed"), """
SELECT f.target, r.id AS item, r.rating, r.catalog, r.click, 2 AS level
FROM (SELECT DISTINCT target, item FROM lvl1) f
JOIN rev r ON r.item2 = f.item
JOIN allowed a ON a.target = f.target AND a.catalog = r.catalog
WHERE r.id <> f.target
  AND NOT EXISTS (SELECT 1 FROM lvl1 x WHERE x.target = f.target AND x.item = r.id)""")
cte("cands", ("lvl1", "lvl2"), """
SELECT target, item, rating, catalog, click, level FROM (
  SELECT *, row_number() OVER (PARTITION BY target, item
                               ORDER BY level, click DESC, rating DESC, catalog) AS rn
  FROM (SELECT * FROM lvl1 UNION ALL SELECT * FROM lvl2))
WHERE rn = 1""")

oracle("target_catalogs", ("tcat",), "SELECT item, catalog FROM tcat")
oracle("candidates_level1", ("lvl1",), """
SELECT target, item, rating, catalog, click FROM (
  SELECT *, row_number() OVER (PARTITION BY target, item
                               ORDER BY click DESC, rating DESC, catalog) AS rn FROM lvl1)
WHERE rn = 1""")
oracle("candidates", ("cands",), "SELECT * FROM cands")

# -- content ranking -----------------------------------------------------------------------------

cte("pdocs", ("items",), """
SELECT CAST(itemid AS BIGINT) AS item, coalesce(TRY_CAST(parent_id AS BIGINT), -1) AS parent,
       concat_ws(' ', lower(trim(attr1)), lower(trim(attr2)), lower(trim(attr3)),
                 lower(trim(attr4)), lower(trim(attr5))) AS sentence
FROM items""")
cte("ddocs", (), """
SELECT doc_id AS item,
       coalesce(TRY_CAST(regexp_extract(source, '(\\d+)$', 1) AS BIGINT), -1) AS parent,
       concat_ws(' ', lower(trim(source)), lower(trim(lang)), lower(trim(text))) AS sentence
FROM documents""")
def _words(docs: str) -> str:
    return ("SELECT item, list_distinct(list_filter(regexp_split_to_array(lower(sentence), "
            "'[^\\p{L}\\w\\d]+'), lambda w: length(w) >= 2)) AS words FROM " + docs)


def _content(prefix: str, cands: str, docs: str) -> None:
    """CTEs <prefix>_... for one binding: members, term rows, scores, rankings."""
    p = prefix
    cte(f"{p}_words", (docs,), _words(docs))
    cte(f"{p}_dset", (cands,), f"""
SELECT target, item, level, click, rating FROM {cands}
UNION ALL
SELECT DISTINCT target, target AS item, 1 AS level, CAST(0 AS BIGINT) AS click, 0.0 AS rating
FROM {cands}""")
    cte(f"{p}_members", (f"{p}_dset", docs), f"""
SELECT * FROM {p}_dset WHERE item IN (SELECT item FROM {docs})""")
    cte(f"{p}_rows", (f"{p}_members", f"{p}_words"), f"""
SELECT m.target, m.item, t.term
FROM {p}_members m JOIN (SELECT item, unnest(words) AS term FROM {p}_words) t ON t.item = m.item""")
    cte(f"{p}_msz", (f"{p}_members",), f"SELECT target, count(*) AS m FROM {p}_members GROUP BY target")
    cte(f"{p}_shared", (f"{p}_rows",), f"""
SELECT r.target, r.item, r.term FROM {p}_rows r
WHERE r.item <> r.target
  AND EXISTS (SELECT 1 FROM {p}_rows o WHERE o.item = o.target AND o.target = r.target
                                          AND o.term = r.term)""")
    cte(f"{p}_idf", (f"{p}_shared", f"{p}_msz"), f"""
SELECT d.target, d.term, ln((m.m + 1) / (d.df + 1)) AS w
FROM (SELECT target, term, count(*) + 1 AS df FROM {p}_shared GROUP BY 1, 2) d
JOIN {p}_msz m ON m.target = d.target""")
    for kind in ("count", "tfidf"):
        if kind == "count":
            src = f"SELECT target, item, 1.0 AS w FROM {p}_shared"
            deps = (f"{p}_shared",)
        else:
            src = (f"SELECT s.target, s.item, i.w FROM {p}_shared s "
                   f"JOIN {p}_idf i ON i.target = s.target AND i.term = s.term")
            deps = (f"{p}_shared", f"{p}_idf")
        cte(f"{p}_{kind}_scores", deps, f"""
SELECT target, item,
       CASE WHEN count(*) <= 1 THEN 0.0
            ELSE coalesce(sum(w * w) / nullif(sqrt(sum(w * w)) * sqrt(sum(w * w)), 0), 0.0) END AS cos
FROM ({src}) GROUP BY target, item""")
        cte(f"{p}_{kind}_ranked", (cands, docs, f"{p}_{kind}_scores"), f"""
SELECT target, item, cos, ordered,
       row_number() OVER (PARTITION BY target ORDER BY cos DESC, ordered DESC, item ASC) AS rank
FROM (SELECT c.target, c.item, round(coalesce(s.cos, 0.0), 12) AS cos,
             100 + c.click * c.rating AS ordered
      FROM {cands} c
      JOIN {docs} d ON d.item = c.item
      JOIN {docs} td ON td.item = c.target
      LEFT JOIN {p}_{kind}_scores s ON s.target = c.target AND s.item = c.item
      WHERE c.item <> c.target AND d.parent <> td.parent)""")


cte("dterms", ("ddocs",), "SELECT item, unnest(words) AS term FROM (" + _words("ddocs") + ")")
cte("dcands", ("dterms",), """
SELECT DISTINCT r.item AS target, t.item, 0.0 AS rating, 0 AS catalog, CAST(0 AS BIGINT) AS click, 1 AS level
FROM (SELECT o.item, o.term, row_number() OVER (PARTITION BY o.item ORDER BY f.df, o.term) AS rn
      FROM dterms o JOIN (SELECT term, count(*) AS df FROM dterms GROUP BY term HAVING count(*) > 1) f ON f.term = o.term
      WHERE o.item % 20 = 0) r
JOIN dterms t ON t.term = r.term
WHERE r.rn <= 3 AND t.item <> r.item""")
_content("pc", "cands", "pdocs")
_content("dc", "dcands", "ddocs")


# MurmurHash3 (32 bits, seed 42) of a term's UTF-8 bytes, four at a time, the
# rest as one padded word; then the non-negative remainder.
_U = "4294967296"


def _rotl(x: str, r: int) -> str:
    return f"((({x}) * {2 ** r} % {_U}) + ({x}) // {2 ** (32 - r)})"


def _mixed(k: str) -> str:
    turned = _rotl(f"({k} * 3432918353::HUGEINT % {_U})", 15)
    return f"({turned} * 461845907::HUGEINT % {_U})"


def _word(at: str) -> str:
    """Little-endian word of the hex text hx (padded with zeros) that starts at byte ``at``."""
    return " + ".join(f"('0x' || substr(hx, CAST(2 * ({at} + {k}) + 1 AS BIGINT), 2))::HUGEINT * {256 ** k}" for k in range(4))


def _shifted(x: str, r: int) -> str:
    return f"xor({x}, {x} // {2 ** r})"


def _buckets(words: str, features: int) -> str:
    return f"""
SELECT item, term, bucket FROM (SELECT DISTINCT unnest(words) AS term FROM {words}) u
JOIN (SELECT term AS t, CAST(((h4 + 2147483648) % {_U} - 2147483648 + {_U}) % {features} AS INTEGER) AS bucket FROM (
  SELECT term, {_shifted("h3", 16)} AS h4 FROM (
  SELECT term, {_shifted("h2", 13)} * 3266489909 % {_U} AS h3 FROM (
  SELECT term, {_shifted("h1", 16)} * 2246822507 % {_U} AS h2 FROM (
  SELECT term, xor(xor(h0, CASE WHEN n % 4 = 0 THEN 0::HUGEINT ELSE {_mixed("tail")} END), n::HUGEINT) AS h1 FROM (
  SELECT term, n, {_word("4 * (n // 4)")} AS tail,
         list_reduce(list_prepend(42::HUGEINT, list_transform(range(n // 4), lambda i: {_mixed("(" + _word("4 * i") + ")")})),
           lambda h, k: ({_rotl("xor(h, k)", 13)} * 5 + 3864292196) % {_U}) AS h0
  FROM (SELECT term, octet_length(encode(term)) AS n, hex(encode(term)) || '00000000' AS hx
        FROM (SELECT DISTINCT unnest(words) AS term FROM {words})))))))) b ON b.t = u.term
JOIN (SELECT item, unnest(words) AS w FROM {words}) i ON i.w = u.term"""


def _hashed(p: str, cands: str, docs: str, features: int) -> None:
    """CTEs of the hashed ranking of one binding."""
    cte(f"{p}_hterms", (f"{p}_words",), _buckets(f"{p}_words", features))
    cte(f"{p}_tf", (f"{p}_hterms",), f"SELECT item, bucket, count(*) AS tf FROM {p}_hterms GROUP BY 1, 2")
    cte(f"{p}_hshared", (f"{p}_members", f"{p}_tf"), f"""
SELECT m.target, m.item, c.bucket, c.tf AS tc, t.tf AS tt
FROM {p}_members m JOIN {p}_tf c ON c.item = m.item
JOIN {p}_tf t ON t.item = m.target AND t.bucket = c.bucket WHERE m.item <> m.target""")
    cte(f"{p}_hscores", (f"{p}_hshared", f"{p}_msz"), f"""
SELECT target, item, CASE WHEN count(*) <= 1 THEN 0.0
       ELSE coalesce(sum(tc * tt * w * w) / nullif(sqrt(sum(tt * tt * w * w)) * sqrt(sum(tc * tc * w * w)), 0), 0.0) END AS cos
FROM (SELECT s.target, s.item, tc, tt, ln((m.m + 1) / (d.df + 1)) AS w
      FROM {p}_hshared s JOIN {p}_msz m ON m.target = s.target
      JOIN (SELECT target, bucket, count(*) + 1 AS df FROM {p}_hshared GROUP BY 1, 2) d
        ON d.target = s.target AND d.bucket = s.bucket)
GROUP BY target, item""")
    cte(f"{p}_hashed_ranked", (cands, docs, f"{p}_hscores"), f"""
SELECT target, item, cos, ordered,
       row_number() OVER (PARTITION BY target ORDER BY cos DESC, ordered DESC, item ASC) AS rank
FROM (SELECT c.target, c.item, round(coalesce(s.cos, 0.0), 12) AS cos, 100 + c.click * c.rating AS ordered
      FROM {cands} c JOIN {docs} d ON d.item = c.item JOIN {docs} td ON td.item = c.target
      LEFT JOIN {p}_hscores s ON s.target = c.target AND s.item = c.item
      WHERE c.item <> c.target AND d.parent <> td.parent)""")


_hashed("pc", "cands", "pdocs", 64)
_hashed("dc", "dcands", "ddocs", 1 << 18)


def _ranked(src: str) -> str:
    return f"SELECT target, item, round(cos, 6) AS cos, round(ordered, 6) AS ordered, rank FROM {src}"


oracle("item_sentences", ("pc_dset", "pdocs"), """
SELECT s.target, s.item, d.parent, s.level, s.click, s.rating, d.sentence
FROM pc_dset s JOIN pdocs d ON d.item = s.item""")
oracle("item_words", ("pc_words",), "SELECT item, array_to_string(list_sort(words), ',') AS words FROM pc_words")
oracle("tfidf_weights", ("pc_rows", "pc_msz"), """
SELECT r.target, r.term, r.df, m.m, round(ln((m.m + 1) / (r.df + 1)), 6) AS idf
FROM (SELECT target, term, count(*) AS df FROM pc_rows GROUP BY 1, 2) r
JOIN pc_msz m ON m.target = r.target""")
oracle("count_rank", ("pc_count_ranked",), _ranked("pc_count_ranked"))
oracle("tfidf_rank", ("pc_tfidf_ranked",), _ranked("pc_tfidf_ranked"))
oracle("tfidf_rank_docs", ("dc_tfidf_ranked",), _ranked("dc_tfidf_ranked"))
cte("ph_terms", ("pc_words",), _buckets("pc_words", 1 << 18))
cte("ph_tf", ("ph_terms",), "SELECT item, bucket, count(*) AS tf FROM ph_terms GROUP BY 1, 2")
oracle("hashing_tfidf_ml", ("ph_tf", "pdocs"), """
SELECT p.item, coalesce(string_agg(t.bucket || ':' || format('{:,.4f}', t.tf * f.idf), ',' ORDER BY t.bucket), '') AS features
FROM pdocs p LEFT JOIN ph_tf t ON t.item = p.item
LEFT JOIN (SELECT bucket, ln(((SELECT count(*) FROM pdocs) + 1) / (count(*) + 1)) AS idf FROM ph_tf GROUP BY bucket) f
  ON f.bucket = t.bucket
GROUP BY p.item""")
oracle("hashed_tfidf_rank", ("pc_hashed_ranked",), _ranked("pc_hashed_ranked"))
oracle("hashed_tfidf_rank_docs", ("dc_hashed_ranked",), _ranked("dc_hashed_ranked"))
oracle("ranking_overlap", ("pc_count_ranked", "pc_tfidf_ranked"), """
SELECT b.target, round(coalesce(n.k, 0) / b.k, 6) AS overlap
FROM (SELECT target, count(*) AS k FROM pc_tfidf_ranked GROUP BY target) b
LEFT JOIN (SELECT t.target, count(*) AS k
           FROM pc_tfidf_ranked t JOIN pc_count_ranked c ON c.target = t.target AND c.item = t.item
           GROUP BY t.target) n ON n.target = b.target""")
oracle("rec_documents", ("pc_tfidf_ranked",), f"""
SELECT CAST(target AS VARCHAR) AS item, chunk,
       string_agg(CAST(item AS VARCHAR) || ':' || CAST(trunc(ordered) AS BIGINT), ','
                  ORDER BY CAST(item AS VARCHAR)) AS recoms
FROM (SELECT *, {_chunk("item")} AS chunk
      FROM (SELECT *, count(*) OVER (PARTITION BY target) AS n FROM pc_tfidf_ranked))
GROUP BY target, chunk""")
