"""Linear-referencing analytics on Spark: rings, laps, cyclic intervals, signals and layered labels."""
