"""Small frames that every operator must cope with, and plain helpers of the brute-force versions."""

import re

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAME_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(6000))
SHARED = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
#: (doc_id, text): null id, null text, empty, blank, repeated rows, ties, a very long text, shared passages.
DOCS = [
    (1, f"Start here. {SHARED} and then the end."),
    (2, f"Another opening, {SHARED.replace(' ', '  ')}\nother ending!"),
    (3, None), (4, ""), (5, " \n\t "), (6, "single"), (7, "single"),
    (8, LONG), (9, LONG + " tail"), (9, LONG + " tail"), (None, f"nameless {SHARED}"), (None, None),
    (10, "Héllo WÖRLD 漢字 🎉 it's  twice\x1c\x85 it's  twice"), (11, "a " * 300), (12, SHARED),
    (13, "All rights reserved. Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
    (14, "the GENERAL, public -- license of CC\nby all"), (15, SHARED.replace("one", "uno")),
]
#: Columns no operator asks for, under names operators use themselves.
CLASHES = ["n_words", "score", "ids", "fp", "component", "chunk", "key", "kept", "k0", "key0", "word", "label", "block", "n_tokens",
           "first", "root", "body", "mark", "scanned", "order_id", "items", "n_hit"]


def frame(spark, rows=DOCS, clashes=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if clashes:
        df = df.selectExpr("*", *[f"cast(null as {'string' if i % 2 else 'int'}) as `{c}`" for i, c in enumerate(CLASHES)])
    return df


def empty(spark):
    return frame(spark, [])


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
