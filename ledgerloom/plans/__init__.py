"""Wiring: bindings onto the benchmark tables, the retail model, the query
catalogue and its SQL oracle, and the layered batch run."""
