"""Names, schemas and limits shared by every module."""

from pyspark.sql import types as T

# Annotation set names.
PAR = "PAR"
SENT = "SENT"
TOKEN = "TOKEN"
POS = "POS"
NE = "NE"
NP = "NP"

BASE_SETS = (PAR, SENT, TOKEN, POS)
ALL_SETS = (*BASE_SETS, NE, NP)
# Cells of documents that a job set aside; the type of the row is the message.
ERROR = "ERROR"

# Tokens of a sentence above which it is split, where document numbers wrap.
MAX_SENTENCE_TOKENS = 100
MAX_DOCUMENT_NUMBER = 32767

# Characters that one part of an encoded cell covers; longer documents have more parts.
CELL_CHARS = 1024 * 1024

# Items of one part of a list; longer lists have more parts.
LIST_ITEMS = 1024

# Annotation ids hold the sentence above this many bits and the token below.
SENTENCE_ID_BITS = 32
SENTENCE_ID_STEP = 1 << SENTENCE_ID_BITS

ANNOTATIONS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("set", T.StringType()),
    T.StructField("ann_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
])

# One element of an encoded cell.
CELL_ITEM = T.StructType(ANNOTATIONS.fields[2:])

ANNOTATION_COLUMNS = ANNOTATIONS.fieldNames()
