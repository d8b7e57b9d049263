"""Results are only right with exactly these."""

# Fixed value: a title is the first run of letters that a dot follows.
TITLE_PATTERN = r"([A-Za-z]+)\."

# Title as written -> title used for grouping.
TITLE_REMAP = {
    "Mlle": "Miss",
    "Mme": "Miss",
    "Ms": "Miss",
    "Dr": "Mr",
    "Major": "Mr",
    "Lady": "Mrs",
    "Countess": "Mrs",
    "Jonkheer": "Other",
    "Col": "Other",
    "Rev": "Other",
    "Capt": "Mr",
    "Sir": "Mr",
    "Don": "Mr",
}

# Rounded mean age of each title group.
TITLE_MEAN_AGES = {"Miss": 22, "Other": 46, "Master": 5, "Mr": 33, "Mrs": 36}

# Fixed value: date partitions are named in this format.
DATE_FORMAT = "yyyy-MM-dd"

# Columns of a decoded event, in order.
EVENT_COLUMNS = ["Offset", "Time (readable)", "Timestamp", "Body"]

# Fixed value: history is the original data moved back by two days.
HISTORY_SHIFT_SECONDS = 172800

# Fixed value: an integer token with a dash in it stands for "missing".
MISSING_INT = -1

# Fixed value: words are separated by runs of white space.
WORD_SEPARATOR = r"\s+"
