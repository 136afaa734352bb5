"""DuckDB SQL that answers the same questions as the registered queries."""
