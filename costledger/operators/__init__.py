from .convert import attach_rate, finish_usd, process_ad_rows, stamp_lineage, to_usd  # noqa: F401
from .dedup import cost_order, keep_highest_cost, rank_by_cost, top_by_cost  # noqa: F401
from .sequence import lag_in_order, rank_in_order  # noqa: F401
from .files import (content_owner, files_missing, files_new, files_reuploaded,  # noqa: F401
                    files_unchanged,
                    first_per_content, last_version_per_name, listing_names, live_versions,
                    names_not_listed, previous_version_other_name)
from .merge import (consolidate_outer, delete_versions, fold_files, fold_max_cost,  # noqa: F401
                    merge_max_cost, tombstone, upsert_registry)
from .rates import (explode_rates, latest_rate_per_currency, parse_rates_payload,  # noqa: F401
                    rate_lookup, rates_on_latest_date)
from .sizing import known_size, materialize_df  # noqa: F401
