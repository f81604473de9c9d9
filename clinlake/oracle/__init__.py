"""DuckDB SQL oracle used to verify every registered query."""
