"""The library's operators bound to the test tables, and the same questions as DuckDB SQL."""
