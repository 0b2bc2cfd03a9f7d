"""Small tables with the awkward rows every operator must take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "fp long, node long, component long, hits string, x double, chain int, twin int, line string, site string, key string, __key string"


def docs_of(spark, rows, clash=False):
    """``rows`` of (doc_id, text, source); ``clash`` adds columns named like the operators' own."""
    data = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    df = spark.createDataFrame(data, SCHEMA)
    if clash:
        for c in CLASH.split(", "):
            name, kind = c.split()
            if name != "__key":
                df = df.selectExpr("*", f"cast(null as {kind}) as `{name}`")
    return df


LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))

AWKWARD = [
    (1, "The first plain text, with a few words in it.\nA second line stands here.", "a"),
    (1, "The first plain text, with a few words in it.\nA second line stands here.", "a"),
    (2, None, "a"),
    (3, "", "b"),
    (4, " \t\n", None),
    (None, "A text without any id at all, but with words.", "b"),
    (None, None, None),
    (5, LONG, "c"),
    (6, "one", "c"),
    (6, "another text under the same id", "c"),
    (7, "ÉTÉ à Zürich, straße № 5 — 你好 ́ <|endoftext|> it's", "d"),
]
