"""Sources and sinks: fixture adapters, typed readers/writers, the idempotent sink."""
