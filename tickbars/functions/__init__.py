from tickbars.functions.ordering import digit_order, latest_by_key, pair_order
from tickbars.functions.times import hour_of, instant, lookback_start, to_ntz

__all__ = ["digit_order", "hour_of", "instant", "latest_by_key", "lookback_start", "pair_order", "to_ntz"]
