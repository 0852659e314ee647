"""DataFrame operators: ``f(df, column names...) -> DataFrame``."""
