"""Small documents with every awkward case, and the schema of the table."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# Names that the operators use themselves.
CLASHES = (
    "position line key h1 h2 row_hash n_lines dropped token_ids class digest signature path topic "
    "n_tokens lang_pred weight share votes posterior fingerprint batch score component_id kept of_a"
).split()

WORDS = {
    "en": "the house that stood upon a hill was old and nobody knew who had built it there before".split(),
    "de": "das haus stand auf dem hügel und niemand wusste wer es früher dort gebaut hatte können".split(),
    "fr": "la maison était sur la colline et personne ne savait qui l’avait bâtie là autrefois été".split(),
}


def text_of(lang, n, seed):
    return " ".join(random.Random(seed).choices(WORDS[lang], k=n))


def plain_rows(count=60):
    langs = sorted(WORDS)
    rows = []
    for i in range(count):
        lang = langs[i % 3]
        text = text_of(lang, 60 + 7 * (i % 11), i)
        rows.append((i, f"{text}.\nA line that many documents hold.", lang, f"s{i % 4}", len(text)))
    return rows


def awkward_rows():
    """Nulls in every column, empty and blank texts, repeats, ties, and a very long text."""
    long = "\n".join(text_of("en", 40, k) for k in range(1500))
    rows = plain_rows(24)
    rows += [
        (100, None, "en", "s1", 0),
        (101, "", "en", "s1", 0),
        (102, " \t\n \x0b\r\n", "en", None, 8),
        (103, long, None, "s2", len(long)),
        (104, long, "en", "s2", None),
        (105, rows[3][1], "en", "s3", 5),
        (105, rows[3][1], "en", "s3", 5),
        (106, "one text of a repeated id", "en", "s0", 3),
        (106, "another text of a repeated id", "en", "s0", 3),
        (None, "a text without an id", "en", "s0", 3),
        (None, None, None, None, None),
        (107, "1234 5678 !!! --- 90", "en", "s0", 3),
        (108, "\x00 odd \x1c characters \x85 　 and 😀 <|endoftext|> ends  here ", "en", "s0", 3),
        (-5, "Zahlen und Wörter, früher gebaut.", "de", "s0", 3),
    ]
    return rows


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        for name in CLASHES:
            df = df.selectExpr("*", f"concat('{name}', doc_id) AS `{name}`")
    return df
