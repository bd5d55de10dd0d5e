from .adfiles import footers, parquet_loader, read_ad_files  # noqa: F401
from .listing import list_objects, listing_from_keys  # noqa: F401
from .rates import (read_rates_ndjson, read_rates_payloads, read_rates_table,  # noqa: F401
                    require_not_null)
