from .columns import (base_name, folder_name, is_missing_number, is_parquet,  # noqa: F401
                      md5_base64, nan_to_null, strictly_greater, utc_instant, version_id)
