"""Fixed values the mapping catalogue must share with the original tool.

These names and words are part of the data contract (column names of the
stored table, the views and the catalogue records), so they are stated here
once, in natural order, and imported everywhere else.
"""

# --- fixed values -----------------------------------------------------------
# Names of the four levels a dotted view-object path is split into.
LEVELS = ("viewObjectModelTop", "viewObjectModel", "viewObjectModelService", "viewObjectName")

# Text columns every mapping sheet must carry (their order among the first four is free).
VIEW_OBJECT = "viewObject"
ATTRIBUTE = "viewObjectAttribute"
TABLE = "databaseTable"
COLUMN = "databaseColumn"
PK_FLAG = "primaryKeyColumn"
ROW_INDEX = "rowIndex"
SHEET = "sheet"

# Flag words: exact, case-sensitive.
YES = "Yes"
NO = "No"

# Rollup measures.
COL_CNT = "colCnt"
COL_CNT_PK = "colCntPK"

# Field order of one primary-key catalogue record.
CATALOGUE_ORDER = (
    "viewObjectModelTop",
    "viewObjectModel",
    "viewObjectModelService",
    "viewObjectName",
    "databaseTable",
    "colCnt",
    "colCntPK",
    "cols",
    "colsDB",
)

# Names of the stored relations.
MAPPINGS_TABLE = "mappings"
OBJECT_VIEW = "mappingsTables"
PK_VIEW = "mappingsPkCols"

# Header discovery: the header is searched among the lines after line 0.
HEADER_SEARCH_LINES = 15

# Record export: text over this many MB per file is written compact.
OUTPUT_MB_LIMIT = 100

# Default names of unnamed datasets in a multi-dataset sink: "Sheet i of n".
DATASET_NAME_PATTERN = "Sheet {i} of {n}"

# Prefix of a dated snapshot name: VYYYY.MM.DD__
SNAPSHOT_PREFIX_FORMAT = "V%Y.%m.%d__"
# ---------------------------------------------------------------------------
