"""Fixed values and tunables shared by the operators."""

from __future__ import annotations

# Fixed values of the data format; results depend on them.
SEPARATOR = "ㆍ"  # between device number and start time in batch_num / intrusion_start_time
ESCAPED_SEPARATOR = "\\u318d"  # the same separator as six-character escape text
LOCAL_ZONE = "Asia/Shanghai"
DEFAULT_EVENT_MS = 1704038400000  # 2024-01-01 00:00:00 +08:00, used when a start time cannot be read
DRONE_TYPE = 1
REMOTE_TYPE = 0
TRACK_STATUS = 1
COMPANY_ID = 29570
UTM_ZONE = 51
SIMILARITY_THRESHOLD = 0.8
WINDOW_SECONDS = 5
SLIDE_SECONDS = 1
WATERMARK_DELAY_MS = 50
CHECKPOINT_TRIGGER = "3 seconds"
PARTITION_COMMIT_DELAY_SECONDS = 3600

# Tunables; results do not depend on them.
TASK_ROWS = 4_000_000  # rows of one key that one task may sort on its own
GRID_TASK_ROWS = 4_000  # rows of one grid cell that meet in one join key before it is salted
SMALL_GRAPH_LINKS = 200_000  # links of one second that one task may union on its own
OPEN_FILES = 24  # partition values that one task writes side by side; it sorts what is left if it has more
TOPIC_CODEC = "gzip"  # of the files of a topic folder; JSON text shrinks to a tenth or less, and a compressed file is read by one task
TOPIC_FILE_ROWS = 25_000  # messages of one compressed file
