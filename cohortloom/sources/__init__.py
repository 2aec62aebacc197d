from cohortloom.sources.schemas import VIEWS, check_view, trim_codes, view_schema
from cohortloom.sources.sinks import DamagedResult, read_csv, write_csv
from cohortloom.sources.warehouse import (
    Warehouse,
    between_days,
    create_database,
    drop_view,
    load,
    load_table,
    replace_view,
    save_table,
    with_year,
)

__all__ = [
    "VIEWS",
    "DamagedResult",
    "Warehouse",
    "between_days",
    "check_view",
    "create_database",
    "drop_view",
    "load",
    "load_table",
    "read_csv",
    "replace_view",
    "save_table",
    "trim_codes",
    "view_schema",
    "with_year",
    "write_csv",
]
