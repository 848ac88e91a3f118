"""End-to-end jobs, the query registry (``registry.queries``) and the SQL twins
(``oracle.oracle_sql``) the driver runs in DuckDB."""
