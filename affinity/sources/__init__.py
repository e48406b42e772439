"""Sources (readers of the reference's input formats), sinks, and the bindings
of the driver's test tables to those shapes."""
