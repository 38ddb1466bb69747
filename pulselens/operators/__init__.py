"""Product-analytics operators: ``(DataFrame..., params) -> DataFrame``."""
