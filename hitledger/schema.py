"""Relations of the access-log data model: column order and types."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


PARTITION_COLUMNS = ["hid", "d", "h", "m5"]
# ``batch`` is the last directory level: it makes republishing one batch a
# plain dynamic partition overwrite.
LAYOUT_COLUMNS = [*PARTITION_COLUMNS, "batch"]

RAW_FIELDS = [
    "hid", "srcip", "destip", "proctype", "srcport",
    "destport", "domain", "url", "duration", "acctime",
]
QUERY_COLUMNS = RAW_FIELDS[1:]

ACCESS_LOG = StructType(
    [StructField("hid", IntegerType()), *_strings(*QUERY_COLUMNS, "d", "h", "m5")]
)
# Addresses as numbers, stored beside their text so that files and stripes have their ranges.
ADDRESS_NUMBERS = {"srcnum": "srcip", "destnum": "destip"}
# As stored: partition columns last. A given schema also stops Spark from
# inferring ``h=08`` as the integer 8.
ACCESS_LOG_TABLE = StructType([
    *_strings(*QUERY_COLUMNS), *[StructField(n, LongType()) for n in ADDRESS_NUMBERS], StructField("hid", IntegerType()),
    *_strings("d", "h", "m5", "batch"),
])

MEASURES = ["firsttime", "activetime", "times"]


def _stat(*names: str) -> StructType:
    types = {"times": LongType(), "isforeign": IntegerType()}
    return StructType([StructField(n, types.get(n, StringType())) for n in names])


# Hour statistics as stored: ``hid``, ``d`` and ``h`` are directory levels.
HOUR_TABLES = {
    "ipportdomain": _stat("destip", "destport", "domain", "proctype", *MEASURES, "hid", "d", "h"),
    "ipport": _stat("destip", "destport", "proctype", *MEASURES, "hid", "d", "h"),
    "domainip": _stat("domain", "topdomain", "destip", *MEASURES, "proctype", "hid", "d", "h"),
    "domain": _stat("domain", "isforeign", *MEASURES, "topdomain", "destip", "hid", "d", "h"),
    "foreigndomain": _stat("domain", "isforeign", *MEASURES, "topdomain", "destip", "hid", "d", "h"),
    "illegLog": _stat("domain", "destip", "hid", "d", "h"),
}

# Column order inside a day TSV file; the domain file's readers rely on it.
DAY_COLUMNS = {
    "ipportdomain": ["hid", "destip", "destport", "domain", "proctype", *MEASURES],
    "ipport": ["hid", "destip", "destport", "proctype", *MEASURES],
    "domainip": ["hid", "domain", "topdomain", "destip", *MEASURES, "proctype"],
    "domain": ["hid", "domain", *MEASURES, "destip", "topdomain"],
    "topdomain": ["hid", "topdomain", "destip", *MEASURES],
    "illegLog": ["hid", "domain", "destip"],
}

FILE_LISTING = ["hid", "d", "h", "m5", "file_path", "file_size"]
