from wintide.sources.schemas import SCHEMAS
from wintide.sources.tables import (
    TableSet,
    attach_database,
    fresh_place,
    parse_schema,
    read_table,
    stage,
    write_table,
)

__all__ = [
    "SCHEMAS",
    "TableSet",
    "attach_database",
    "fresh_place",
    "parse_schema",
    "read_table",
    "stage",
    "write_table",
]
