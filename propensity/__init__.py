"""Propensity ranking as Spark jobs: clean, check, split, model, rank and monitor any table with an id, a time and a 0/1 target."""
