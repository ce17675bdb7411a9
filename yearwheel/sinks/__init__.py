from yearwheel.sinks.bundle import write_bundle, write_table

__all__ = ["write_bundle", "write_table"]
