"""These must equal the surveyed jobs' values for the results to match.

Kept together here; the modules import them.
"""

# Topic of the raw log stream, and the topic marker inside an exposure record.
LOG_TOPIC = "sltadxtopic"
ADX_TOPIC = "sltadxlog-adx-bg"

# Key prefix of the additive exposure counter (key = prefix + deal id).
COUNTER_PREFIX = "adxhappen:"

# Media id used when a channel has no row in the channel table.
MISSING_MEDIA = "000"

# A deal is flagged when its day total exceeds its daily cap minus this slack.
CAP_SLACK = 30

# Micro-batch interval of the streaming jobs.
BATCH_INTERVAL = "10 seconds"

# Rows per executeBatch of the per-partition upsert writer.
UPSERT_BATCH_ROWS = 1000

# Video segmentation: padding added before and after each tagged interval (ms),
# the tag classes kept, and the output list name of each class, in this order:
# class 4 = man, class 1 = object, class 3 = action, class 2 = sence.
PAD_MS = 5000
KEPT_CLASSES = ("1", "2", "3", "4")
CLASS_LISTS = (("4", "man"), ("1", "object"), ("3", "action"), ("2", "sence"))
