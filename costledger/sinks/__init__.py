from .rates import fold_newest, read_newest  # noqa: F401
from .tables import (append_rates, begin_run, latest_run, preview, publish, publish_tables,  # noqa: F401
                     read_carry, read_listing, read_state, read_tables, read_version_dates,
                     run_log, swap_registry, truncate_table, write_ndjson, write_version_dates)
