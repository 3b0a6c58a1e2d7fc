from .keys import business_key_h, business_key_s, hash_key
from .times import LOCAL_ZONE, local_time, local_time_ms, round_to_millis, stamp, utc_text_timestamp

__all__ = [
    "LOCAL_ZONE",
    "business_key_h",
    "business_key_s",
    "hash_key",
    "local_time",
    "local_time_ms",
    "round_to_millis",
    "stamp",
    "utc_text_timestamp",
]
