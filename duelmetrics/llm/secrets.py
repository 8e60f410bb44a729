"""Secret scans: a random forest removes false positives, DataFrame functions and Spark ML only.

Findings are long runs of key characters, runs of any characters after a secret word and an assignment,
passwords in URLs, and headers of private keys. Their features are length, character classes and
transitions, coverage by dictionary words, path and neighbouring words. The dictionary and the letter
transitions are counted over all documents. The forest learns from labelled findings; rules over
neighbouring words label some of the corpus where no labels are given.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelmetrics.llm.common import cut, text_or_empty

SECRET_WORDS = "token|secret|passwd|password|pwd|api[_-]?key|apikey|key|auth|credential|bearer|private"
#: Characters of a long run, its least length, and its pattern: all of a run of such characters, unless
#: they are one character again and again. Possessive parts read every run once.
KEY = "A-Za-z0-9_+/-"
LEAST = 16
LONG = rf"(?<![{KEY}])(?=[{KEY}]{{{LEAST}}})(?!([{KEY}])\1++(?![{KEY}]))[{KEY}]++={{0,2}}+"
#: Least length of a value after a secret word and an assignment, or of a password in a URL. The short
#: look back comes first, so that few places need the long one.
LEAST_VALUE = 6
ASSIGNED = (
    r"(?<=[:=>\s\"'`])(?<=[:=]>?[ \t]{0,8}[\"'`]?)"
    rf"(?<=(?i:{SECRET_WORDS})[\w-]{{0,48}}[\"'`]?[ \t]{{0,8}}[:=]{{1,2}}>?[ \t]{{0,8}}[\"'`]?)"
)
VALUE = "|".join(
    [
        *[rf"(?<={q})[^{q}\s]{{{LEAST_VALUE},}}+(?={q})" for q in "\"'`"],
        rf"[^\s\"'`:=>]\S{{{LEAST_VALUE - 2},}}[^\s,;.)\]}}\"'`]",
    ]
)
IN_URL = rf"(?<=:)(?<=://[^\s/:@]{{0,64}}:)[^\s/@]{{{LEAST_VALUE},}}+(?=@)"
HEADER = "-----BEGIN [A-Z0-9 ]{0,32}PRIVATE KEY-----"
FINDING = f"(?:{HEADER}|{IN_URL}|{ASSIGNED}(?:{VALUE})|{LONG})"
ALPHABET = string.ascii_letters + string.digits + string.punctuation
#: Characters kept on each side.
NEAR = 48
#: A dictionary word has 4 to 8 letters (shorter ones cover much of any random run by chance) and occurs,
#: outside of findings, in at least this share of the documents.
SHORTEST, LONGEST = 4, 8
WORD = rf"(?<![a-z])[a-z]{{{SHORTEST},{LONGEST}}}+(?![a-z])"
WORD_SHARE = 0.0004
#: A finding that has more than this share of all findings is joined with its features in slices.
HOT_SHARE = 0.001
#: Bound of the training sample: about so many findings of each label.
ROWS_PER_LABEL = 20_000
TREES, DEPTH, SEED = 24, 6, 17
#: Findings with at least this score are secrets.
SECRET = 0.5
# Words near other numbers, parts of paths that hold no live secrets.
OTHER_WORDS = "sha1|sha256|md5|checksum|digest|commit|uuid|isbn|phone|card|order|invoice|version|id"
SAFE_PATHS = "test|example|sample|fixture|mock|dummy|doc"

FEATURES = [
    "length", "digits", "uppers", "lowers", "symbols", "hexadecimal", "distinct", "entropy",
    "changes", "transition", "coverage", "assigned", "keyword", "other_word", "quoted_before",
    "quoted_after", "slashes", "in_url", "safe_path", "alone",
]


def findings(df: DataFrame, id_column: str = "doc_id", path_column: str | None = "source") -> DataFrame:
    """Every finding of every whole text: id, path, start (code point), finding, before, after.

    Null texts are empty, a null path is an empty one. Repeated rows give repeated findings.
    """
    path = F.coalesce(F.col(path_column).cast("string"), F.lit("")) if path_column else F.lit("")
    text = F.col("text")
    rows = (
        df.select(F.col(id_column).alias("id"), path.alias("path"), text_or_empty().alias("text"))
        .filter(text.rlike(FINDING))
        .withColumn("found", F.regexp_extract_all(text, F.lit(FINDING), F.lit(0)))
        # the text between findings, in order: one piece more than there are findings
        .withColumn("between", F.split(text, FINDING, -1))
    )
    near = [
        F.col("found"),
        F.transform("between", F.char_length).alias("gap"),
        F.transform("between", lambda b: F.substring(b, -NEAR, NEAR)).alias("before"),
        F.transform(
            F.slice("between", F.lit(2), F.size("found")), lambda b: F.substring(b, 1, NEAR)
        ).alias("after"),
    ]
    each = rows.select(
        "id", "path", F.monotonically_increasing_id().alias("row_no"), F.arrays_zip(*near).alias("f")
    ).select("id", "path", "row_no", F.posexplode("f").alias("nth", "f"))
    # a finding starts after all gaps up to it and all findings before it
    so_far = Window.partitionBy("row_no").orderBy("nth")
    length = F.char_length("f.found")
    return (
        each.withColumn("start", F.sum(F.col("f.gap") + F.coalesce(length, F.lit(0))).over(so_far) - length)
        .filter("f.found is not null")  # the last piece has no finding
        .select(
            "id", "path", F.col("start").cast("long").alias("start"), F.col("f.found").alias("finding"),
            "f.before", "f.after",
        )
    )


def dictionary(df: DataFrame, least_share: float = WORD_SHARE) -> DataFrame:
    """word and docs (documents that have it), over whole texts without their findings.

    Findings are left out, so that neither the copies of a secret nor many random tokens make their own
    pieces into words. The least number of documents is a share of all, so a word is one at every size.
    """
    text = F.lower(F.regexp_replace(text_or_empty(), FINDING, " "))
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    return (
        df.select(F.explode(words).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("docs"))
        .filter(F.col("docs") >= least_share * df.count())
    )


def transitions(words: DataFrame) -> DataFrame:
    """pair and log_p: how likely its second letter follows its first within dictionary words.

    At most 26 x 26 rows. Pairs that never occur, pairs with a digit among them, aren't listed.
    """
    at = F.sequence(F.lit(1), F.char_length("word") - 1)
    pairs = words.select(
        "docs", F.explode(F.transform(at, lambda k: F.substring("word", k, F.lit(2)))).alias("pair")
    )
    counted = pairs.groupBy("pair").agg(F.sum("docs").alias("n"))
    totals = counted.groupBy(F.substring("pair", 1, 1).alias("first")).agg(F.sum("n").alias("all"))
    return counted.join(totals, F.substring("pair", 1, 1) == F.col("first")).select(
        "pair", F.log(F.col("n") / (F.col("all") + 26.0)).alias("log_p")
    )


#: Letters of a finding that are looked at in one row.
PIECE = 4096
#: Log probability of a pair that no dictionary word has.
UNSEEN = -7.0


def _share(pattern: str) -> Column:
    return F.regexp_count("finding", F.lit(pattern)) / F.char_length("finding")


def _joined_in_slices(named: DataFrame, known: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """``named`` with what is known of each distinct finding; copies of a frequent one meet it in many tasks.

    At most 1 / share findings are frequent, so their list is bounded and broadcast. Each has a slice for
    every ``share`` of all rows it has, and its features go to each of its slices.
    """
    least = max(1.0, named.count() * share)
    counts = named.groupBy("of").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    hot = counts.select("of", F.ceil(F.col("n") / least).cast("int").alias("slices"))
    sliced = named.join(F.broadcast(hot), "of", "left").withColumn(
        "slice", F.coalesce(F.pmod(F.xxhash64("id", "start", "before"), F.col("slices")).cast("int"), F.lit(0))
    )
    every = F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)
    repeated = known.join(F.broadcast(hot), "of", "left").withColumn("slice", F.explode(every))
    return sliced.drop("slices").join(repeated.drop("slices"), ["of", "slice"], "left").drop("slice")


def _parts(pieces: DataFrame) -> DataFrame:
    """of, at and word of every run of 4 to 8 letters of the pieces, shorter ones inside of longer ones too.

    A place lies in one piece and has one run of each length, so no two rows are equal and none is looked
    for again: a place without a run makes no row, and nothing is gathered before the join with the words.
    """
    run = lambda k: F.regexp_extract(F.substring("piece", k, F.lit(LONGEST)), "^[a-z]*", 0)
    places = F.transform(
        F.sequence(F.lit(1), F.least(F.char_length("piece"), F.lit(PIECE))),
        lambda k: F.struct((F.col("from") + k - 1).alias("at"), run(k).alias("run")),
    )
    runs = pieces.select("of", F.explode(F.filter(places, lambda s: F.char_length(s["run"]) >= SHORTEST)).alias("s"))
    lengths = F.sequence(F.lit(SHORTEST), F.char_length("s.run"))
    return runs.select("of", "s", F.explode(lengths).alias("m")).select(
        "of", F.col("s.at").alias("at"), F.substring("s.run", F.lit(1), F.col("m")).alias("word")
    )


def with_features(found: DataFrame, words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Adds the FEATURES; findings that are equal share the lookups of letters and words."""
    n = F.char_length("finding")
    named = found.withColumn("of", F.unhex(F.sha2(F.col("finding").cast("binary"), 256)))
    # long findings in pieces, each with the letters that a word beginning in it may still have
    piece = F.lower(F.substring("finding", F.col("from"), F.lit(PIECE + LONGEST - 1)))
    pieces = (
        named.dropDuplicates(["of"])
        .select("of", "finding", F.explode(F.sequence(F.lit(1), n, F.lit(PIECE))).alias("from"))
        .select("of", "from", piece.alias("piece"))
        .filter(F.char_length("piece") > 2)
    )
    size = F.char_length("piece")
    two = pieces.select(
        "of",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.least(size - 1, F.lit(PIECE))),
                lambda k: F.substring("piece", k, F.lit(2)),
            )
        ).alias("pair"),
    )
    likely = (
        two.join(F.broadcast(pairs), "pair", "left")  # at most 26 x 26 pairs
        .groupBy("of")
        .agg(F.avg(F.coalesce("log_p", F.lit(UNSEEN))).alias("transition"))
    )
    covered = (
        _parts(pieces)
        .join(words.select("word"), "word")
        .select(
            "of",
            F.explode(F.sequence(F.col("at"), F.col("at") + F.char_length("word") - 1)).alias("letter"),
        )
        .groupBy("of")
        .agg(F.count_distinct("letter").alias("letters"))
    )
    known = likely.join(covered, "of", "left")
    letters = F.array(*[F.lit(c) for c in ALPHABET])
    spread = F.filter(letters, lambda c: F.instr(F.col("finding"), c) > 0)
    share = F.transform(
        spread, lambda c: (n - F.char_length(F.replace("finding", c, F.lit("")))) / n
    )
    entropy = F.aggregate(share, F.lit(0.0), lambda total, p: total - p * F.log2(p))
    before, after = F.lower("before"), F.lower("after")
    last = F.regexp_extract(before, r"([^\n]*)$", 1)
    in_login = last.rlike(r"://[^\s/:@]*:$") & after.rlike("^@")
    changes = F.regexp_count(
        "finding",
        F.lit(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
    )
    made = {
        "length": n,
        "digits": _share("[0-9]"),
        "uppers": _share("[A-Z]"),
        "lowers": _share("[a-z]"),
        "symbols": _share("[^A-Za-z0-9]"),
        "hexadecimal": F.col("finding").rlike("^[0-9a-f]+$|^[0-9A-F]+$"),
        "distinct": F.size(spread) / n,
        "entropy": entropy,
        "changes": changes / n,
        "transition": F.coalesce("transition", F.lit(UNSEEN)),
        "coverage": F.coalesce("letters", F.lit(0)) / n,
        "assigned": last.rlike(r"[:=]>?\s*[\"'`]?$"),
        "keyword": in_login
        | last.rlike(rf"(?:{SECRET_WORDS})[\w-]*[\s\"'`]*[:=]{{0,2}}>?\s*[\"'`]?$"),
        "other_word": last.rlike(rf"(?<![a-z])(?:{OTHER_WORDS})\W{{0,3}}$"),
        "quoted_before": last.rlike("[\"'`]$"),
        "quoted_after": after.rlike("^[\"'`]"),
        "slashes": F.regexp_count("finding", F.lit("/")),
        "in_url": ~in_login
        & (last.rlike(r"(?:://|www\.|@)\S*$") | after.rlike(r"^(?:@|\.(?:com|org|net|html?)\b)")),
        "safe_path": F.lower("path").rlike(SAFE_PATHS) | last.rlike(rf"(?:{SAFE_PATHS})[\w./-]*$"),
        "alone": last.rlike(r"^\s*$") & after.rlike(r"^\s*(?:\n|$)"),
    }
    return _joined_in_slices(named, known).select(
        "id", "path", "start", "finding", "before", "after",
        *[made[name].cast("double").alias(name) for name in FEATURES],
    )


def label_by_rules(featured: DataFrame) -> DataFrame:
    """Adds label: 1.0 assigned to a secret word and varied for its length, or a private key's header; 0.0 plainly something else, else null."""
    varied = F.col("entropy") >= F.least(F.lit(3.0), 0.8 * F.log2("length"))
    yes = (F.col("keyword") == 1) & (F.col("assigned") == 1) & varied & (F.col("safe_path") == 0)
    header = F.col("finding").rlike(f"^{HEADER}$") & (F.col("safe_path") == 0)
    # a value with digits that is assigned to a secret word is no phrase, whatever words it happens to hold
    named = (F.col("keyword") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0)
    no = (
        (F.col("digits") == 1)
        | (F.col("in_url") == 1)
        | (F.col("other_word") == 1)
        | ((F.col("coverage") >= 0.6) & ~named)
        | ((F.col("slashes") >= 2) & (F.col("keyword") == 0))
    )
    return featured.withColumn("label", F.when(header, 1.0).when(no, 0.0).when(yes, 1.0))


def train(labelled: DataFrame, rows_per_label: int = ROWS_PER_LABEL):
    """A random forest on a bounded sample of the labelled findings; None unless it has both labels.

    The sample takes about `rows_per_label` of each label by a hash of the finding and what stands
    before it, one row of each. Its rate follows from the distinct ones, so copies of a document neither
    fill nor empty it.
    """
    h = F.xxhash64("finding", "before", F.lit(5))
    known = labelled.filter("label is not null").withColumn("h", h)
    distinct = known.groupBy("label").agg(F.count_distinct("h").alias("n"))
    counts = {r["label"]: r["n"] for r in distinct.collect()}
    if len(counts) < 2:
        return None
    rate = F.when(F.col("label") == 1, min(1.0, rows_per_label / counts[1.0])).otherwise(
        min(1.0, rows_per_label / counts[0.0])
    )
    sample = (
        known.filter(F.pmod("h", F.lit(1 << 30)) / float(1 << 30) < rate)
        .dropDuplicates(["h", "label"])
        .select("h", "label", *FEATURES)
    )
    ordered = cut(sample.repartition(8, "h").sortWithinPartitions("h", "label"))
    if ordered.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="vector", labelCol="label"
    )
    return forest.fit(_vectors(ordered))


def _vectors(featured: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(featured)


def scan(
    df: DataFrame,
    labels: DataFrame | None = None,
    id_column: str = "doc_id",
    path_column: str | None = "source",
) -> DataFrame:
    """Every finding with its score and whether it is a secret.

    Returns id, path, start, finding, before, after, the features, label, score and is_secret. `labels`
    (finding, label) gives labelled findings of one's own; without it rules label some. Where only one
    label occurs no forest is learned: a finding then scores its label, or 0.5 without one.
    """
    found = cut(findings(df, id_column, path_column))
    words = cut(dictionary(df))
    featured = cut(with_features(found, words, transitions(words)))
    if labels is None:
        labelled = label_by_rules(featured)
    else:
        given = labels.groupBy("finding").agg(F.max("label").cast("double").alias("label"))
        labelled = featured.join(given, "finding", "left")
    model = train(labelled)
    if model is None:
        scored = labelled.withColumn("score", F.coalesce("label", F.lit(0.5)))
    else:
        scored = (
            model.transform(_vectors(labelled))
            .withColumn("score", F.round(vector_to_array("probability")[1], 9))
            .drop("vector", "rawPrediction", "probability", "prediction")
        )
    return scored.withColumn("is_secret", F.col("score") >= SECRET)


def secrets(df: DataFrame) -> DataFrame:
    """One row per finding, without the finding itself: doc_id, start, length, finding_sha256, score, is_secret."""
    return scan(df).select(
        F.col("id").alias("doc_id"),
        "start",
        F.char_length("finding").cast("long").alias("length"),
        F.sha2(F.col("finding").cast("binary"), 256).alias("finding_sha256"),
        "score",
        "is_secret",
    )
