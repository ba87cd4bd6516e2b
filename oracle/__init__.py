"""DuckDB oracle SQL for every registered query (see ``__spark_entry__.oracle_sql``).

Written independently of the Spark code: the month spread uses the reference's *recursive* form, the
ERP branches use correlated ``EXISTS`` / ``NOT EXISTS``, so agreement checks the closed forms and join
rewrites of the Spark side rather than repeating them.
"""
