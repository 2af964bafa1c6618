from parcelstream.functions.timefn import (  # noqa: F401
    DEFAULT_TZ, estimate_arrive_text, iso_to_millis, iso_to_local_text, millis_to_date,
    millis_to_partition_date, millis_to_ymd_hms, text_to_millis)
from parcelstream.functions.text import mask_name  # noqa: F401
