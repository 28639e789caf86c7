from eventlake.functions.casts import to_double, to_instant, to_whole
from eventlake.functions.identity import natural_key, uuid5_url
from eventlake.functions.intervals import inside, step_label

__all__ = ["inside", "natural_key", "step_label", "to_double", "to_instant", "to_whole", "uuid5_url"]
