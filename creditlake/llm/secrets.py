"""Operator 2: secrets in texts, with a random forest that removes false positives. DataFrame operations only.

1. Candidates are found by one pattern: values of 8 or more characters that are assigned to a secret-like name, and runs
   of 16 or more key characters that mix letters and digits. A name and its '=' are not part of a candidate. Their places follow from the text between them.
2. Features of a candidate: length, shares of digits, capitals and other signs, number of distinct characters, changes of character
   class, vowel-consonant changes, share of its letters that words of the corpus cover (its letter runs against all words
   that occur in ``min_words`` or more places), depth and file ending of a path, and marks of the neighbouring words.
3. A random forest trained from labelled findings scores them. ``labelled_findings`` makes findings from the corpus where no
   reviewed ones are given: secrets of known shapes drawn from hashes of doc_ids, and look-alikes (words, numbers, paths,
   links, checksums, versions, placeholders), set in pieces of corpus text before and after, and searched as texts are.

The fit uses at most ``max_rows`` rows of documents for findings; word counts and the search cover all texts.

Defined results: null and empty texts have no findings. Each occurrence of a candidate is a finding. Rows without doc_id are
searched too; repeated rows each give their findings. Without documents there are no findings and nothing is fitted. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

NAMES = "token|secret|api[_-]?key|apikey|access[_-]?key|private[_-]?key|client[_-]?secret|auth[_-]?key|passwd|password|pwd|credential|bearer"
#: A value after a secret-like name, or a run of key characters with a digit and a letter ('=' only as padding at its end).
PATTERN = (rf"(?<=[:=\s\"'])(?i:(?<=(?<![A-Za-z0-9])(?:{NAMES.replace('?', '{0,1}')})\s{{0,2}}[:=]\s{{0,2}}[\"']{{0,1}}))[^\s\"']{{7,}}[^\s\"',;.)\]}}>]"
           r"|(?<![A-Za-z0-9+/_.@-])(?=[A-Za-z+/_.-]*[0-9])(?=[0-9+/_.-]*[A-Za-z])(?:[A-Za-z0-9+/_.-]{16,}+={0,2}|[A-Za-z0-9+/_.-]{15}={1,2}|[A-Za-z0-9+/_.-]{14}==)(?![A-Za-z0-9@])")
TREES, DEPTH, MAX_ROWS, MIN_WORDS, THRESHOLD, SEED = 40, 8, 2000, 5, 0.5, 17
NEIGHBOURHOOD = 48


def spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, start, end (characters), candidate, and the texts before and after it, of each candidate."""
    text = F.col("text").cast("string")
    rows = docs.select(*keep, text.alias("__text")).filter(F.col("__text").rlike(PATTERN)) \
        .withColumn("__row", F.monotonically_increasing_id()) \
        .withColumn("__found", F.regexp_extract_all("__text", F.lit(PATTERN), F.lit(0))) \
        .withColumn("__between", F.split("__text", PATTERN, -1))
    each = rows.select(*keep, "__row", "__between", "__found", F.posexplode("__found").alias("__n", "candidate"))
    before = F.element_at("__between", F.col("__n") + 1)
    each = each.select(*keep, "__row", "__n", "candidate", F.char_length(before).alias("__gap"),
                       F.right(before, F.lit(NEIGHBOURHOOD)).alias("before"), F.left(F.element_at("__between", F.col("__n") + 2), F.lit(NEIGHBOURHOOD)).alias("after"))
    order = W.partitionBy("__row").orderBy("__n").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("__gap") + F.char_length("candidate")).over(order).cast("int")
    return each.withColumn("end", end).withColumn("start", (F.col("end") - F.char_length("candidate")).cast("int")) \
        .select(*keep, "start", "end", "candidate", "before", "after")


def corpus_words(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """word: the words of 2 letters or more that occur in at least ``min_words`` texts' places, of all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.col("text").cast("string")), "[^a-z]+")).alias("word"))
    return words.filter(F.length("word") > 1).groupBy("word").count().filter(F.col("count") >= min_words).select("word")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The findings with their features; ``words`` as of ``corpus_words``."""
    c = F.col("candidate")
    n = F.char_length(c)
    near = F.lower(F.concat_ws(" ", F.regexp_extract("before", r"(\S+\s*\S*\s*\S*)$", 1)))
    count = lambda p: F.regexp_count(c, F.lit(p)).cast("double")
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    keyed = found.withColumn("__f", F.monotonically_increasing_id())
    runs = keyed.select("__f", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-z]{2,})"), 1))).alias("word"))
    covered = runs.join(words, "word").groupBy("__f").agg(F.sum(F.length("word")).alias("__covered"))
    letters = F.char_length(F.regexp_replace(c, "[^A-Za-z]", ""))
    signs = F.array_distinct(F.split(c, ""))
    return keyed.join(covered, "__f", "left").select(
        *found.columns,
        n.cast("double").alias("length"),
        (count("[0-9]") / n).alias("digits"), (count("[A-Z]") / n).alias("capitals"), (count("[^A-Za-z0-9]") / n).alias("signs"),
        F.size(signs).cast("double").alias("distinct"), (F.size(signs) / n).alias("variety"),
        (count("(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])") / n).alias("changes"),
        (count("(?i)(?<=[aeiou])(?=[b-df-hj-np-tv-z])|(?<=[b-df-hj-np-tv-z])(?=[aeiou])") / F.greatest(letters, F.lit(1))).alias("voicing"),
        F.least(F.coalesce("__covered", F.lit(0)) / F.greatest(letters, F.lit(1)), F.lit(1.0)).alias("coverage"),
        count("/").alias("path_depth"), flag(c.rlike(r"\.[A-Za-z]{1,5}$")).alias("file_ending"), flag(c.rlike("^[0-9a-f]+$|^[0-9A-F]+$")).alias("hexadecimal"),
        flag(c.rlike("^[A-Z]{3,5}[A-Z0-9]{12,}$|^[a-z]{2,4}[-_]")).alias("prefixed"), flag(c.rlike(r"(?i)example|sample|changeme|x{5,}|1234567|placeholder|test")).alias("placeholder"),
        flag(near.rlike(NAMES)).alias("secret_word"), flag(F.col("before").rlike(r"[:=]\s*[\"']?$")).alias("assigned"),
        flag(F.col("before").rlike("[\"']$")).alias("quoted"), flag(near.rlike(r"commit|sha|checksum|hash|digest|md5|revision|version|uuid|id\b|file|path|http|see")).alias("public_word"))


FEATURES = ["length", "digits", "capitals", "signs", "distinct", "variety", "changes", "voicing", "coverage", "path_depth", "file_ending", "hexadecimal", "prefixed",
            "placeholder", "secret_word", "assigned", "quoted", "public_word"]


def labelled_findings(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """candidate, before, after and label (1: secret): findings made from at most ``max_rows`` documents, 16 of each."""
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text")).filter("id is not null and text is not null")
    ids = rows.select("id").orderBy(F.xxhash64("id"), "id").limit(max_rows).distinct()  # so at most max_rows rows are broadcast
    texts = rows.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text").alias("text"))
    split = F.filter(F.split(F.regexp_replace("text", r"[^A-Za-z\s]", ""), r"\s+"), lambda w: F.length(w) > 1)
    drawn = texts.select("id", split.alias("words")).repartition(8, "id")  # the words are split once
    salted = lambda s: F.concat(F.col("id"), F.lit(s))
    hexa = lambda s, k: F.left(F.sha2(salted(s), 512), F.lit(k))
    mixed = lambda s, k: F.left(F.regexp_replace(F.base64(F.unhex(F.sha2(salted(s), 512))), "[+/=]", ""), F.lit(k))
    place = lambda s: (F.pmod(F.xxhash64(salted(s)), F.greatest(F.size("words"), F.lit(1))) + 1).cast("int")
    word = lambda s: F.coalesce(F.try_element_at("words", place(s)), F.lit("word"))
    whole = lambda s, k: F.lpad(F.abs(F.xxhash64(salted(s))).cast("string"), k, "7").substr(F.lit(1), F.lit(k))
    pick = lambda s, *names: F.element_at(F.array(*[F.lit(x) for x in names]), (F.pmod(F.xxhash64(salted(s)), F.lit(len(names))) + 1).cast("int"))
    left = F.concat_ws(" ", word("p"), word("q"))
    secret_name = pick("n", "token", "secret", "api_key", "password", "access_key", "client_secret", "auth_key")
    assign = pick("a", ' = "', "=", ": ", ' = ', ': "', "='")
    public = pick("u", "commit ", "sha256 ", "checksum: ", "md5 ", "revision ", "see ", "file ", "id: ", "digest = ", "hash=")
    kinds = [
        (hexa("1", 40), 1, True), (hexa("2", 32), 1, True), (hexa("3", 64), 1, True), (mixed("4", 40), 1, True), (mixed("5", 24), 1, True),
        (F.concat(F.lit("AKIA"), F.upper(mixed("6", 16))), 1, None), (F.concat(F.lit("ghp_"), mixed("7", 36)), 1, None), (F.concat(F.lit("sk-"), mixed("8", 44)), 1, None),
        (hexa("9", 40), 0, False), (hexa("10", 32), 0, False), (F.concat(word("a"), F.lit("_"), word("b"), F.lit("_"), whole("c", 4)), 0, False),
        (F.concat(F.lit("/"), word("d"), F.lit("/"), word("e"), whole("c", 2), F.lit("/"), word("f"), F.lit(".txt")), 0, False),
        (F.concat(word("g"), F.lit("-"), word("h"), F.lit("-v"), whole("i", 1), F.lit("."), whole("j", 2)), 0, None),
        (F.concat(word("k"), word("l"), word("m"), whole("n", 2)), 0, True),
        (F.concat(F.lit("example"), whole("o", 6), F.lit("changeme")), 0, True),
        (F.concat(F.lit("www."), word("r"), F.lit(".com/"), word("s"), F.lit("/"), whole("t", 5)), 0, False),
    ]
    made = F.array(*[F.struct(value.alias("value"), F.concat_ws(" ", left, F.concat(secret_name, assign) if named else (public if named is False else F.lit(""))).alias("before"),
                              F.lit(label).alias("label")) for value, label, named in kinds])
    set_in = drawn.select(F.explode(made).alias("f"), F.concat_ws(" ", F.lit(""), word("v"), word("w")).alias("after")) \
        .select("f.value", F.col("f.label").cast("double").alias("label"), F.concat("f.before", "f.value", "after").alias("text"))
    # only what the search finds, in the neighbourhood that it gives
    return spans(set_in, ["value", "label"]).filter("candidate = value").select("candidate", "before", "after", "label")


def train(findings: DataFrame, words: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> RandomForestClassificationModel:
    """Fit from labelled findings (candidate, before, after, label)."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(findings, words))
    ordered = stored(rows.select("features", "label"), "findings")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.7).fit(ordered)


def scored(found: DataFrame, words: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(found, words))
    return model.transform(rows).select(*found.columns, F.col("coverage"), vector_to_array("probability")[1].alias("score"))


def find_secrets(docs: DataFrame, findings: DataFrame | None = None, keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` (default: doc_id), start, end, candidate, score and is_secret of every candidate in the texts."""
    keep = ["doc_id"] if keep is None else keep
    words = corpus_words(docs)
    found = stored(spans(docs, keep), "found")
    labelled = labelled_findings(docs) if findings is None else findings
    labelled = stored(labelled, "labelled")
    # only the words that findings hold are looked up
    runs = found.select("candidate").unionByName(labelled.select("candidate")) \
        .select(F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("([a-z]{2,})"), 1)).alias("word")).distinct()
    known = stored(words.join(runs, "word", "left_semi"), "words")
    if labelled.agg(F.count_distinct("label")).first()[0] < 2:
        return found.select(*keep, "start", "end", "candidate", F.lit(1.0).alias("score"), F.lit(True).alias("is_secret"))
    model = train(labelled, known)
    return scored(found, known, model).select(*keep, "start", "end", "candidate", "score", (F.col("score") >= threshold).alias("is_secret"))


def masked(candidate: Column) -> Column:
    """First and last two characters with the length: enough to recognise a finding, not to use it."""
    return F.concat(F.left(candidate, F.lit(2)), F.lit("..."), F.right(candidate, F.lit(2)), F.lit(" ("), F.char_length(candidate).cast("string"), F.lit(")"))


def redacted(docs: DataFrame, key: str, secrets: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with secret spans replaced. ``key`` names a column that determines the text (as a hash of it does);
    ``secrets`` holds it with start and end."""
    listed = secrets.groupBy(F.col(key).alias("__key")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("__spans"))
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.try_element_at("__spans", i)["end"])
    pieces = F.transform("__spans", lambda s, i: F.concat(F.substring("text", before(i) + 1, s["start"] - before(i)), F.lit(mark)))
    tail = F.expr("substring(text, element_at(__spans, -1).end + 1)")
    new = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return docs.join(listed, F.col(key) == F.col("__key"), "left").withColumn("text", new).select(*docs.columns)


def op2_secrets(spark: SparkSession, root: str) -> DataFrame:
    found = find_secrets(table(spark, root, "documents"))
    return found.select("doc_id", "start", "end", masked(F.col("candidate")).alias("finding"), F.round("score", 6).alias("score"), "is_secret")
