"""Fixed schemas of the stored tables and of the text inputs."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

BASES = ("A", "C", "G", "T")
LOWER_BASES = ("a", "c", "g", "t")

# Column names and their order, as stored tables and text inputs have them.
USE_COLUMNS = ["use_w", "use_a", "use_c", "use_g", "use_t"]
MUTATION_SCORES = [f"{b}_mutation_max_score" for b in LOWER_BASES]
STRAND_SCORES = [f"{s}_{d}" for s in ("wt", *LOWER_BASES) for d in ("fwd", "rev")]

MOTIF_TEXT_COLUMNS = [
    "motif_id",
    "name",
    "species",
    "status",
    "family_name",
    "dbd",
    "motif_type",
    "msource_identifier",
    "msource_type",
    "msource_author",
]


def _struct(*columns):
    return StructType([StructField(name, kind) for name, kind in columns])


# The `tfbs` table: one row per (position, motif) that can bind as is or after one substitution.
SITES = _struct(
    ("chromosome", LongType()),
    ("mutation_pos", LongType()),
    ("chromosome_chunk", LongType()),
    ("pwmid", LongType()),
    *((c, BooleanType()) for c in USE_COLUMNS),
    ("wt_max_score", DoubleType()),
    *((c, DoubleType()) for c in MUTATION_SCORES),
)

# The `tf_info` dimension. `row_id` is the motif number that `tfbs.pwmid` refers to.
MOTIFS = _struct(
    *((c, StringType()) for c in MOTIF_TEXT_COLUMNS),
    ("pmid", LongType()),
    ("file", StringType()),
    ("score_threshold", DoubleType()),
    ("row_id", LongType()),
)

# Scanner output before strands are merged. Scores that were not kept are NULL.
HITS = _struct(
    ("chromosome", LongType()),
    ("mutation_pos", LongType()),
    ("chunk_id", LongType()),
    ("pwmid", LongType()),
    ("event", LongType()),
    *((c, DoubleType()) for c in STRAND_SCORES),
)

# Directory names of the two tables below a table directory, and their view names.
SITES_DIR = "tfbs.pq"
MOTIFS_DIR = "tf_info.pq"
SITES_VIEW = "tfbs"
MOTIFS_VIEW = "tf_info"
