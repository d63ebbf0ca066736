"""Named queries over the driver tables (``queries``) and their DuckDB SQL (``oracle``)."""
