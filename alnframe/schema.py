"""Data model: column names, sentinels, types and fixed values of the alignment format."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (SAM format) -------------------------------------------------------
# Flag bits.
FLAG_PAIRED = 0x1
FLAG_PROPER_PAIR = 0x2
FLAG_UNMAPPED = 0x4
FLAG_MATE_UNMAPPED = 0x8
FLAG_REVERSE = 0x10
FLAG_MATE_REVERSE = 0x20
FLAG_FIRST = 0x40
FLAG_SECOND = 0x80
FLAG_SECONDARY = 0x100
FLAG_QC_FAIL = 0x200
FLAG_DUPLICATE = 0x400

# "No value" sentinels of a read record.
NO_REF_NAME = "*"
NO_REF_INDEX = -1
NO_START = 0
NO_CIGAR = "*"
NO_SEQ = "*"
NO_QUAL = "*"
NO_MAPQ = 0
UNKNOWN_MAPQ = 255
MAX_INSERT_SIZE = 1 << 29

# CIGAR operators and what they consume.
CIGAR_OPS = "MIDNSHP=X"
OPS_CONSUME_READ = ["M", "I", "S", "=", "X"]
OPS_CONSUME_REF = ["M", "D", "N", "=", "X"]
OPS_ALIGN = ["M", "=", "X"]
OPS_CLIP = ["S", "H"]

# Binning scheme: level first-bin numbers, shifts and the span of bin 0.
BIN_LEVEL_STARTS = [0, 1, 9, 73, 585, 4681]
BIN_LEVEL_SHIFTS = [29, 26, 23, 20, 17, 14]
BIN_GENOMIC_SPAN = 512 * 1024 * 1024
MAX_BINS = 37450
LINEAR_WINDOW_SHIFT = 14

# Interval merge slack used when turning sorted reads into regions.
READ_INTERVAL_SLACK = 51

# Regions kept by the pipeline: reference indexes 1..24 (chr1..chr22, chrX, chrY).
MIN_REGION = 1
MAX_REGION = 24

# Sequence dictionary of the generated/adapter reads: chrM, chr1..chr22, chrX, chrY.
ADAPTER_CONTIG_LENGTH = 1_000_000

# The fixed read-group values the pipeline stamps on every read.
PIPELINE_READ_GROUP = {"id": "GROUP1", "library": "LIB1", "platform": "ILLUMINA",
                       "platform_unit": "UNIT1", "sample": "SAMPLE1"}

# Variant calling thresholds: call and emit confidence, allele fractions.
MIN_CALL_QUAL = 30.0
MIN_ALT_FRACTION = 0.2
HOM_ALT_FRACTION = 0.8

# Duplicate marking: base qualities at or above this count into the read score.
DUP_MIN_BASE_QUAL = 15

# VCF header written by the pipeline sink.
VCF_HEADER = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tls"


def adapter_contig_names() -> list[str]:
    """chrM, chr1..chr22, chrX, chrY (index order of the adapter dictionary)."""
    return ["chrM"] + [f"chr{i}" for i in range(1, 23)] + ["chrX", "chrY"]


CIGAR_ELEMENT = T.StructType([T.StructField("len", T.IntegerType()), T.StructField("op", T.StringType())])
CIGAR_OPS_TYPE = T.ArrayType(CIGAR_ELEMENT)
BLOCK = T.StructType([
    T.StructField("read_start", T.IntegerType()),
    T.StructField("ref_start", T.IntegerType()),
    T.StructField("len", T.IntegerType()),
])
BLOCKS_TYPE = T.ArrayType(BLOCK)

TAG_VALUE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("s", T.StringType()),
    T.StructField("i", T.LongType()),
    T.StructField("f", T.FloatType()),
    T.StructField("bytes", T.BinaryType()),
    T.StructField("ia", T.ArrayType(T.LongType())),
    T.StructField("fa", T.ArrayType(T.FloatType())),
    T.StructField("atype", T.StringType()),
])
TAGS_TYPE = T.MapType(T.StringType(), TAG_VALUE)

VALIDATION_ERROR = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
])
ERRORS_TYPE = T.ArrayType(VALIDATION_ERROR)

ALIGNMENTS = T.StructType([
    T.StructField("read_name", T.StringType()),
    T.StructField("flag", T.IntegerType()),
    T.StructField("ref_name", T.StringType()),
    T.StructField("ref_index", T.IntegerType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("mapq", T.IntegerType()),
    T.StructField("cigar", T.StringType()),
    T.StructField("mate_ref_name", T.StringType()),
    T.StructField("mate_ref_index", T.IntegerType()),
    T.StructField("mate_pos", T.IntegerType()),
    T.StructField("isize", T.IntegerType()),
    T.StructField("seq", T.StringType()),
    T.StructField("qual", T.StringType()),
    T.StructField("tags", TAGS_TYPE),
    T.StructField("record_no", T.LongType()),
    T.StructField("source", T.StringType()),
])

SEQUENCES = T.StructType([
    T.StructField("seq_index", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("md5", T.StringType()),
    T.StructField("uri", T.StringType()),
    T.StructField("assembly", T.StringType()),
    T.StructField("species", T.StringType()),
])
