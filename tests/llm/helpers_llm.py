"""Plain restatements of the contracts, used as brute force."""

import re

SMOKE = "/root/testdata/sf0.001"

#: texts that every operator over documents must survive
ODD_TEXTS = [None, "", " \n\t ", "a", "é", "word " * 30_000, "\x00\x01", "same text here", "same text here", "ÀÉ ſK İ", "\n\n\n"]


def odd_docs(spark):
    """Nulls, empty, very long and repeated rows; extra columns with the operators' own names."""
    rows = [(i if i != 3 else None, t, "x", "y", 1.0) for i, t in enumerate(ODD_TEXTS)] + [(1, "", "x", "y", 1.0)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, score string, spans string, fp double")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def words(s):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(s))


def tokens(s):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(s))
