"""Secret scans: candidates by pattern, false positives removed by a random forest.

All in DataFrame functions and Spark's own forest. A candidate is described by
its length, changes between kinds of characters, how much of it words that many
documents hold cover, signs of paths and addresses, and the words beside it.
"""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import bounded_sample, bucketed, free_name, staged

MARK = "[SECRET]"
# Names of credentials, and the prefixes of known tokens.
NAMES = r"pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|credential"
# A known token or key ends by its own length, or before a full stop that ends a
# sentence; sk- begins ordinary names too, so it needs a digit or a long run.
AWS = r"(?<![A-Z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Z0-9])"
PROVIDERS = (
    r"(?<![A-Za-z0-9])(?:ghp_|gho_|ghs_|github_pat_|glpat-|sk_live_|rk_live_|xox[abprs]-|AIza|ya29\."
    r"|sk-(?=[\w.-]{0,64}?(?:\d|\w{16})))[\w.-]{15,}[\w-]"
)
PLACEHOLDER = r"(?i)example|changeme|placeholder|dummy|sample|your|xxxx|\*\*\*|^<|1234567|^test"
#: Lengths of dictionary words.
SHORTEST, LONGEST = 4, 12
HEADER = r"-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
#: A private key: its header, and all through its END line. Where that is
#: missing, header fields and lines of 16 or more base64 characters, with at
#: most two shorter last ones; line ends may be escaped, quoted or spaces.
BLOCK = (
    rf"{HEADER}(?:(?:(?!-----(?:BEGIN|END))[\s\S])*+-----END [A-Z0-9 ]{{0,30}}PRIVATE KEY(?: BLOCK)?-----"
    r"|(?:(?:\r?\n|(?:\\r)?\\n)[ \t>]*+[A-Za-z][A-Za-z-]{0,30}: [^\r\n\\]*+)*+"
    r"(?:(?:\\[nrt]|[\s>\"',\\|#*]|\+(?=\s))*+[A-Za-z0-9+/=]{16,}+)++"
    r"(?:(?:\s|\\[nr])[ \t>]*+[A-Za-z0-9+/]{0,15}={1,2}(?![\w+/=])"
    r"|(?:\r?\n|(?:\\r)?\\n)[ \t>]*+[A-Za-z0-9+/=]{1,15}+(?=[ \t]*(?:[\r\n\\\"']|$))){0,2}+)?+"
)
#: A private key, a named value, a key of a known format, or a run of token
#: characters that has a digit; such a run also begins where a key ends.
CANDIDATE = (
    rf"{BLOCK}"
    rf"|(?i:{NAMES})[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?(?:(?!{HEADER})[^\s\"',;]){{4,}}+"
    rf"|{AWS}|{PROVIDERS}"
    rf"|(?:(?<![\w+/=.@:-])|\G)(?=[A-Za-z_+/=.@:-]*+\d)(?:(?!{HEADER}|{AWS}|{PROVIDERS})[\w+/=.@:-]){{12,}}+"
)
#: Kinds that the format of a value tells.
FORMATS = ("private_key", "access_key", "provider_token")


def candidates(rows: DataFrame, row: str) -> DataFrame:
    """(row, nth, start, found, before, after) of every match; start counts characters from 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    matches = rows.select(
        F.col(row).alias("row"), "doc_id", "text", F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("m")
    ).filter(F.size("m") > 0)
    parted = matches.select("row", "doc_id", "m", F.split("text", CANDIDATE, -1).alias("gaps"))
    ends = F.aggregate(
        F.arrays_zip(F.col("gaps"), F.col("m")),
        F.array(F.lit(0)),
        lambda at, x: F.concat(at, F.array(F.element_at(at, -1) + F.length(x["gaps"]) + F.coalesce(F.length(x["m"]), F.lit(0)))),
    )
    one = F.explode(F.arrays_zip("m", F.slice("gaps", 1, F.size("m")).alias("left"), F.slice("gaps", 2, F.size("m")).alias("right"), F.slice(ends, 1, F.size("m")).alias("at"), F.sequence(F.lit(0), F.size("m") - 1).alias("nth")))
    return parted.select("row", "doc_id", one.alias("c")).select(
        "row",
        "doc_id",
        F.col("c.nth").alias("nth"),
        (F.col("c.at") + F.length("c.left")).alias("start"),
        F.col("c.m").alias("found"),
        F.expr("right(c.left, 40)").alias("before"),
        F.expr("left(c.right, 40)").alias("after"),
    )


def _share(value: Column, kind: str) -> Column:
    return 1 - F.length(F.regexp_replace(value, kind, "")) / F.length(value)


def dictionary(rows: DataFrame, most: int = 3000, least: int = 3) -> DataFrame:
    """The ``most`` words of four to twelve letters that occur in the most rows, ``least`` or more.

    All rows and whole texts are counted; a word counts once for each row. Ties go by the word.
    """
    standing = rf"(?<![\p{{L}}\d_])\p{{L}}{{{SHORTEST},{LONGEST}}}+(?![\p{{L}}\d_])"
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(standing), F.lit(0)))
    counts = rows.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most).select("word")


def covered(found: DataFrame, words: DataFrame) -> DataFrame:
    """(row, nth, covered): how many characters of the value lie in a word of ``words``, which are few.

    Every part of a run of letters that is as long as a word is looked up, so words may overlap.
    """
    runs = F.regexp_extract_all(F.lower("value"), F.lit(rf"\p{{L}}{{{SHORTEST},}}"), F.lit(0))
    runs = found.select("row", "nth", F.posexplode(runs).alias("place", "run"))
    begins = runs.withColumn("at", F.explode(F.sequence(F.lit(1), F.length("run") - (SHORTEST - 1))))
    sizes = F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length("run") - F.col("at") + 1))
    parts = begins.withColumn("size", F.explode(sizes))
    parts = parts.withColumn("word", F.substring("run", F.col("at"), F.col("size"))).drop("run")
    at, to = F.col("at"), F.col("at") + F.col("size") - 1
    hits = parts.join(F.broadcast(words), "word").select("row", "nth", "place", F.explode(F.sequence(at, to)).alias("at"))
    return hits.distinct().groupBy("row", "nth").agg(F.count("*").alias("covered"))


def valued(found: DataFrame) -> DataFrame:
    """Adds named, kind and value (without the name before it)."""
    named = F.col("found").rlike(rf"^(?i:{NAMES})[\"']?\s*[=:]")
    value = F.when(named, F.regexp_extract("found", r"[=:]\s*[\"']?(.*)$", 1)).otherwise(F.col("found"))
    kind = (
        F.when(F.col("found").startswith("-----BEGIN"), "private_key")
        .when(F.col("value").rlike(AWS), "access_key")
        .when(F.col("value").rlike(PROVIDERS), "provider_token")
        .when(named, "named_value")
        .otherwise("token")
    )
    return found.withColumn("named", named).withColumn("value", value).filter(F.length("value") > 0).withColumn("kind", kind)


def described(found: DataFrame) -> DataFrame:
    """Adds features; ``covered`` is a column of ``found``."""
    v, named = F.col("value"), F.col("named")
    shape = F.regexp_replace(v, "[a-z]+", "a")
    shape = F.regexp_replace(F.regexp_replace(shape, "[A-Z]+", "A"), "[0-9]+", "0")
    before = F.lower("before")
    features = [
        F.length(v),
        (F.length(shape) - 1) / F.length(v),
        _share(v, "[a-z]"),
        _share(v, "[A-Z]"),
        _share(v, "[0-9]"),
        _share(v, "[0-9a-fA-F]"),
        _share(v, "[0-9A-Za-z]"),
        F.col("covered") / F.length(v),
        _share(v, "(?i)[aeiou]"),
        F.size(F.array_distinct(F.split(v, ""))) / F.length(v),
        v.contains("/").cast("int"),
        v.contains(".").cast("int"),
        v.contains("@").cast("int"),
        v.contains(":").cast("int"),
        v.rlike("(?i)://|^www|\\.(com|org|net|html|png|jpg|js|py|txt)").cast("int"),
        named.cast("int"),
        before.rlike(rf"(?:{NAMES}|key|auth|bearer|login)\W{{0,4}}(?:is|are|=|:)?\W{{0,4}}$").cast("int"),
        before.rlike(r"(?:sha|md5|hash|commit|digest|uuid|id|checksum|phone|tel|call|mail)\W{0,4}$").cast("int"),
        before.rlike("[\"']$").cast("int"),
        before.rlike("[/.]$").cast("int"),
        F.col("after").rlike("^[\"']").cast("int"),
        F.length(F.regexp_extract("before", r"(\S*)\s*$", 1)),
        F.length(F.regexp_extract("after", r"^\s*(\S*)", 1)),
    ]
    array = F.array(*[F.coalesce(f.cast("double"), F.lit(0.0)) for f in features])
    return found.withColumn("features", array).drop("named", "covered")


def rule_label(found: DataFrame) -> Column:
    """1 for values of a credential's format, 0 for addresses, numbers, digests and placeholders, else NULL.

    The tables have no findings that people have labelled; these labels stand in
    for them, and ``fit`` takes any others.
    """
    v, kind = F.col("value"), F.col("kind")
    # A key's format is judged by itself; a private key's body may spell anything.
    keys = F.regexp_extract_all(v, F.lit(f"{AWS}|{PROVIDERS}"), F.lit(0))
    fake = (
        F.when(kind == "private_key", False)
        .when(kind.isin(*FORMATS), F.forall(keys, lambda k: k.rlike(PLACEHOLDER)))
        .otherwise(v.rlike(PLACEHOLDER))
    )
    plain = (
        v.rlike(r"^[\w.+-]+@")
        | v.rlike(r"^[\d.:/@+=_-]+$")
        | v.rlike(r"://|^www\.")
        | v.rlike(r"^(?i:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{128})$")
        | v.rlike(r"^(?i:[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12})$")
    )
    mixed = v.rlike("[0-9]") & v.rlike("[A-Za-z]") & (F.length(v) >= 8)
    return (
        F.when(fake, 0)
        .when(kind.isin(*FORMATS), 1)
        .when((kind == "named_value") & mixed, 1)
        .when((kind == "token") & plain, 0)
    )


def fit(labelled: DataFrame, max_rows: int = 20_000, trees: int = 40, depth: int = 8):
    """A forest on (features, label), of at most ``max_rows`` (``bounded_sample``), or None without both labels."""
    if labelled.select("label").distinct().count() < 2:
        return None
    rows = bounded_sample(labelled, "label", max_rows).select(array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=8, featureSubsetStrategy="sqrt")
    return forest.fit(rows)


def labels_of(found: DataFrame, label, findings: DataFrame | None) -> DataFrame:
    """``found`` with ``label``: that of the labelled findings, else what ``label`` says, which may be NULL."""
    if findings is None:
        return found.withColumn("label", label(found))
    # A value that was labelled both ways is a secret.
    known = findings.groupBy("value_sha256").agg(F.max("label").cast("int").alias("known"))
    joined = found.withColumn("value_sha256", F.sha2("value", 256)).join(known, "value_sha256", "left")
    return joined.withColumn("label", F.coalesce("known", label(found))).drop("value_sha256", "known")


def scan(rows: DataFrame, row: str, label=rule_label, least: float = 0.5, findings: DataFrame | None = None) -> DataFrame:
    """Per candidate: row, doc_id, nth, start, length, kind, value_sha256, score and is_secret.

    ``row`` tells the rows of ``rows`` apart. The forest learns from candidates
    to which ``label`` gives 0 or 1; where only one of them occurs, the score is
    1 for values of a credential's format or name, else 0. A value of a known
    format with label 1 scores 1, whatever the forest says. ``findings`` (value_sha256,
    label 0 or 1) are findings that people have labelled, of any kind: their labels go
    before ``label``, and the forest learns from them too; others may be NULL. A NULL or empty text
    has no candidates; a text of any length is searched whole. A repeated row is
    scanned as often as it occurs. Other columns are not read.
    """
    found = staged(valued(candidates(rows, row)), "candidates")
    parts = covered(found, staged(dictionary(rows), "dictionary"))
    found = described(found.join(parts, ["row", "nth"], "left"))
    found = staged(labels_of(found, label, findings), "described")
    forest = fit(found.filter("label is not null"))
    if forest is None:
        score = F.when(F.col("kind") == "token", 0.0).otherwise(1.0)
        scored = found.withColumn("score", score)
    else:
        sure = F.coalesce(F.col("kind").isin(*FORMATS) & (F.col("label") == 1), F.lit(False))
        found = found.withColumn("sure", sure)
        scored = forest.transform(found.withColumn("vector", array_to_vector("features")).drop("features").withColumnRenamed("vector", "features"))
        score = F.when(F.col("sure"), 1.0).otherwise(F.round(vector_to_array("probability")[1], 6))
        scored = scored.withColumn("score", score)
    return scored.select(
        "row",
        "doc_id",
        "nth",
        F.col("start").cast("long").alias("start"),
        F.length("found").cast("long").alias("length"),
        "kind",
        F.sha2("value", 256).alias("value_sha256"),
        "score",
        (F.col("score") >= least).alias("is_secret"),
    )


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written with a column that numbers its rows, and that column's name."""
    row = free_name(docs, "row")
    return bucketed(docs, row), row


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in text replaced by a mark; n_chars, if there, follows."""
    rows, row = numbered(docs)
    secrets = scan(rows, row).filter("is_secret").groupBy("row").agg(F.collect_set("nth").alias("secret_nth"))
    secrets = staged(secrets.withColumnRenamed("row", row), "secrets")
    text, nth = F.coalesce("text", F.lit("")), free_name(docs, "secret_nth")
    joined = rows.join(secrets.withColumnRenamed("secret_nth", nth), row, "left")
    shown = F.transform(
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)),
        lambda m, i: F.when(F.array_contains(nth, i), F.lit(MARK)).otherwise(m),
    )
    parts = F.zip_with(F.split(text, CANDIDATE, -1), shown, lambda g, m: F.concat(g, F.coalesce(m, F.lit(""))))
    new = F.when(F.col(nth).isNull(), F.col("text")).otherwise(F.array_join(parts, ""))
    out = joined.withColumn("text", new)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.col(nth).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
        out = out.withColumn("n_chars", length)
    return out.select(*docs.columns)
