"""Secrets in text: candidates by pattern, false positives removed by a random forest. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import shared_table

_CODE = r"A-Za-z0-9+/_=.\-"
_VALUE = rf"[{_CODE}]{{16,}}"
#: Words that name secrets, words that name harmless codes, and common words inside codes.
_SECRET_WORDS = "token|secret|passw|pwd|api.?key|access.?key|auth|bearer|credential|private.?key|client.?key"
#: The words before a value and its own word, between blanks: a value after a secret word and a sign, an option or `Bearer`.
_ASSIGNED = (
    rf"(?i)(?:(?:{_SECRET_WORDS})[A-Za-z0-9_.\-]{{0,40}}[\"'`\])]{{0,3}} ?(?:=>|:=|={{1,3}}|:)|(?:^| )--?[a-z\-]{{0,20}}(?:{_SECRET_WORDS})[a-z_\-]{{0,20}} |(?:^| )bearer ) ?"
    r"[\"'`(\[{]{0,3}([^ ]{6,})$"
)
_URL_PASSWORD = r"://[^/@: ]{0,200}:([^/ ]+)@"
# Bounded repeats, since Java's matcher goes one level deeper with each.
_PRIVATE_KEY = r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----(?:[^-]*+(?:-(?!----)[^-]*+){0,200}-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----)?"
_HARMLESS_WORDS = (
    "commit|sha-?1|sha-?256|sha-?512|md5|digest|checksum|hash|etag|uuid|guid|revision|integrity|serial|invoice|order|"
    "isbn|phone|card|account|tracking|build|version|mailto"
)
_PLACEHOLDER = "example|sample|dummy|placeholder|your|changeme|xxxx|test|redacted|todo|0000|1234567"
_DICTIONARY = (
    "the|and|for|that|with|this|from|have|user|name|file|path|data|list|item|type|view|page|home|main|index|model|"
    "service|server|client|config|update|create|delete|get|set|account|address|number|value|string|error|time|date|"
    "tion|ment|able|ing|ent|ous|http|www|com|org|net|html|php"
)
_BIGRAMS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|ea|ra|ce|li|ch|ll|be|ma|si|om|ur"
FEATURES = (
    "length",
    "digits",
    "capitals",
    "symbols",
    "only_hex",
    "only_digits",
    "transitions",
    "distinct",
    "dictionary",
    "bigrams",
    "placeholder",
    "path_like",
    "address_like",
    "quoted",
    "assigned",
    "secret_near",
    "harmless_near",
    "risky_path",
    "url_password",
    "private_key",
    "code_like",
)


@dataclass(frozen=True)
class SecretParams:
    """`labelled` findings are made for training unless given; `threshold`: least share of the trees."""

    labelled: int = 6000
    trees: int = 24
    depth: int = 8
    threshold: float = 0.5
    seed: int = 17


_SPACE = r"[ \t\r\n]+"


def candidates(texts: DataFrame) -> DataFrame:
    """The rows of `texts` (keys, text, path) once for each candidate: place, part, at, value, word and its neighbours.

    A candidate is a run of at least 16 code characters that has a digit or often changes case, a value
    of at least 6 characters of any kind that follows a secret word and a sign, the password of an
    address, or a private key from its header line to its end (the header alone where it has none).
    Of two that overlap in a word the longer one counts. `place` is the number of its (first) word,
    `at` its first character there, `part` its number in the word. Texts are read whole.
    """
    keys = [x for x in texts.columns if x != "text"]
    named = F.col("text").rlike(f"(?i){_SECRET_WORDS}")
    words = texts.where(F.col("text").rlike(f"{_VALUE}|://") | named)
    words = words.withColumn("named", named).withColumn("words", F.split("text", _SPACE))
    # Neighbours go into each word's own struct, so the rows made of them carry no arrays.
    numbered = F.transform(
        "words",
        lambda word, i: F.struct(
            i.alias("place"),
            word.alias("word"),
            *(F.coalesce(F.get("words", i + k), F.lit("")).alias(n) for k, n in ((-2, "second"), (-1, "before"), (1, "after"))),
        ),
    )

    def able(x: Column) -> Column:
        follows = F.concat_ws(" ", x["second"], x["before"], x["word"]).rlike(_ASSIGNED)
        coded = (F.length(x["word"]) >= 16) & x["word"].rlike(_VALUE)
        return coded | x["word"].rlike(_URL_PASSWORD) | F.when(F.col("named"), (F.length(x["word"]) >= 6) & follows).otherwise(False)

    found = words.select(*keys, F.explode(F.filter(numbered, able)).alias("c")).select(*keys, "c.*")
    # Pieces of a word between other characters, one by one, with their first characters.
    pieces = F.split("word", f"[^{_CODE}]")
    ends = F.aggregate(
        pieces,
        F.array(F.lit(0)),
        lambda sofar, x: F.concat(sofar, F.array(F.element_at(sofar, -1) + F.length(x) + 1)),
    )
    runs = F.transform(
        pieces, lambda x, i: F.struct((F.get("ends", i) + 1).alias("at"), F.regexp_replace(x, r"[.=\-]+$", "").alias("value"))
    )
    cased = lambda x: F.regexp_count(x, F.lit("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")) >= F.length(x) / 4
    runs = F.filter(runs, lambda x: (F.length(x["value"]) >= 16) & (x["value"].rlike("[0-9]") | cased(x["value"])))
    captured = F.regexp_extract(F.concat_ws(" ", "second", "before", "word"), _ASSIGNED, 1)
    begin = F.length("word") - F.length(captured) + 1
    quote = F.substring("word", begin - 1, F.lit(1))
    # A quoted value ends with its quote; marks after a bare one are not of it.
    bare = F.when(quote.isin('"', "'", "`"), F.call_function("substring_index", captured, quote, F.lit(1))).otherwise(captured)
    assigned = F.struct(begin.alias("at"), F.regexp_replace(bare, r"[\"'`,;)\]}>]+[^A-Za-z0-9]*$", "").alias("value"))
    in_address = F.regexp_extract("word", _URL_PASSWORD, 1)
    lead = F.regexp_extract("word", _URL_PASSWORD.replace("([^/ ]+)", "[^/ ]+").replace("://", "(://", 1).replace(":[", ":)[", 1), 1)
    address = F.struct((F.position(F.concat(lead, in_address, F.lit("@")), F.col("word")) + F.length(lead)).alias("at"), in_address.alias("value"))
    harmless = F.array(*(F.lit(x) for x in ("bearer", "digest", "negotiate")))
    others = F.filter(
        F.when(assigned["at"] == address["at"], F.array(assigned)).otherwise(F.array(assigned, address)),
        lambda x: ~F.array_contains(harmless, F.lower(x["value"])) & ((F.length(x["value"]) >= 6) | (x["at"] == address["at"]) & (x["value"] != "")),
    )

    def stop(x: Column) -> Column:
        return x["at"] + F.length(x["value"])

    def within(x: Column, all_of: Column) -> Column:
        meets = lambda y: (y["at"] < stop(x)) & (x["at"] < stop(y))
        longer = lambda y: (F.length(y["value"]) > F.length(x["value"])) | (F.length(y["value"]) == F.length(x["value"])) & (y["at"] < x["at"])
        return F.exists(all_of, lambda y: meets(y) & longer(y))

    found = found.withColumn("ends", ends).withColumn("runs", runs).withColumn("others", others)
    # Equal spans are one; the run's struct and the assigned one's are alike.
    found = found.withColumn("all_of", F.array_distinct(F.concat("runs", "others")))
    kept = F.filter("all_of", lambda x: ~within(x, F.col("all_of")))
    near = ("place", "word", "second", "before", "after")
    values = found.select(*keys, *near, F.posexplode(kept).alias("part", "v")).select(*keys, *near, "part", "v.at", "v.value")

    blocks = texts.where(F.col("text").contains("PRIVATE KEY")).select(
        *keys, F.split("text", _PRIVATE_KEY, -1).alias("rest"), F.regexp_extract_all("text", F.lit(f"({_PRIVATE_KEY})"), F.lit(1)).alias("all_values")
    )
    # Keys neither begin nor end with white space, so the runs of it before one add up.
    gaps = lambda x: F.transform(x, lambda y: F.regexp_count(y, F.lit(_SPACE)))
    blocks = blocks.withColumn("gaps", F.zip_with(gaps("rest"), F.concat(F.array(F.lit(0)), gaps("all_values")), lambda x, y: x + y))
    first = F.aggregate(F.slice("gaps", 1, F.col("i") + 1), F.lit(0), lambda a, x: a + x)
    blocks = blocks.select(*keys, "gaps", "rest", F.posexplode("all_values").alias("i", "value"))
    lead = F.regexp_extract(F.get("rest", F.col("i")), r"([^ \t\r\n]*)$", 1)
    empty = F.lit("")
    blocks = blocks.select(
        *keys, first.alias("place"), F.col("value").alias("word"), empty.alias("second"), empty.alias("before"), empty.alias("after"),
        F.lit(0).alias("part"), (F.length(lead) + 1).alias("at"), "value",
    )
    return values.unionByName(blocks)


def with_features(found: DataFrame) -> DataFrame:
    """Shares are of the candidate's length; neighbours are the two words before it, the one after, and its own word."""
    value, size = F.col("value"), F.length("value")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / size

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")

    lead = F.left("word", F.when(F.startswith("word", F.lit("-----BEGIN")), 0).otherwise(F.col("at") - 1))
    near = F.lower(F.concat_ws(" ", "second", "before", lead))
    around = F.concat_ws(" ", near, F.lower("after"))
    edges = r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])"
    covered = F.length(F.regexp_replace(F.lower(value), f"({_DICTIONARY})", ""))
    return found.select(
        "*",
        size.cast("double").alias("length"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("capitals"),
        share("[^A-Za-z0-9]").alias("symbols"),
        flag(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("only_hex"),
        flag(value.rlike("^[0-9.+/=-]+$")).alias("only_digits"),
        share(edges).alias("transitions"),
        (F.size(F.array_distinct(F.split(value, ""))) / size).alias("distinct"),
        (1 - covered / size).alias("dictionary"),
        share(f"(?i)({_BIGRAMS})").alias("bigrams"),
        flag(F.lower(value).rlike(_PLACEHOLDER)).alias("placeholder"),
        share("[/.]").alias("path_like"),
        flag(F.lower("word").rlike("://|@|www[.]|[.](com|org|net|html?|php|js|css|png|jpe?g)([^a-z]|$)")).alias("address_like"),
        flag(lead.rlike("[\"'`]$")).alias("quoted"),
        flag(F.concat_ws("", "before", lead).rlike("[=:][\"'`]?$")).alias("assigned"),
        flag(near.rlike(_SECRET_WORDS)).alias("secret_near"),
        flag(around.rlike(f"(^|[^a-z])({_HARMLESS_WORDS})")).alias("harmless_near"),
        flag(F.lower("path").rlike("(^|[/_.-])(env|config|settings|credentials|deploy|secrets?)([/_.-]|$)")).alias("risky_path"),
        flag(lead.rlike("://[^/@:]*:$")).alias("url_password"),
        flag(value.startswith("-----BEGIN")).alias("private_key"),
        flag(value.rlike(r"[(){}\[\]$<>]|^(?i:null|none|true|false|string|undefined)$|^[a-z]+[._][a-z]")).alias("code_like"),
    )


def labelled_findings(spark: SparkSession, rows: int) -> DataFrame:
    """text, path, label: made findings of the usual kinds, secret (1) or harmless (0); neighbours vary by row."""
    code = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    mixed = F.regexp_replace(F.base64(F.unhex(code)), "[=]", "")
    number = F.conv(F.substring(code, 1, 12), 16, 10)

    def pick(words: str, salt: int) -> Column:
        return F.get(F.split(F.lit(words), "\\|"), F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(words.count("|") + 1)).cast("int"))

    plain = pick("the|of|thing|order|data|wir|les|para|and|it|is|on", 1)
    secret = pick("token|secret|password|api_key|auth_token|access_key|client_secret|passwd|TOKEN|Secret", 2)
    harmless = pick("commit|sha256|md5|digest|checksum|etag|uuid|revision|build|integrity", 3)
    sign = pick(" = |=|: |:| = \"|=\"|: '", 4)
    word = pick("getUserAccountAddress|configUpdateService|indexMainPageView|createClientModelList|deleteItemDataFile", 5)
    # 8 to 15 characters of any kind, and letters only.
    size = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(8)).cast("int") + 8
    short = F.concat(F.substring(mixed, 1, 3), pick("!|@|#|$|&|%|^|*|-|_|7|x", 10), F.substring(mixed, F.lit(5), size - 5), pick("3|&9|!|Q|#1|z4", 11))
    plain_value = pick("required|string|process.env.TOKEN|getPassword()|${DB_PASSWORD}|undefined|changeme|example|<password>|self.secret|optional|os.environ['KEY']|config.get('x')|********|invalid|missing|password|incorrect", 12)

    def letters(n: int) -> Column:
        return F.substring(F.translate(F.concat(mixed, F.base64(F.col("id").cast("string").cast("binary"))), "0123456789+/=", "qWeRtYuIoPaSd"), 1, n)

    kinds = (
        (1, F.concat(plain, F.lit(" "), secret, sign, F.substring(code, 1, 40))),
        (1, F.concat(plain, F.lit(" "), secret, sign, F.substring(code, 1, 32))),
        (1, F.concat(secret, sign, F.substring(mixed, 1, 40))),
        (1, F.concat(secret, sign, F.substring(mixed, 1, 20), F.lit("7"))),
        (1, F.concat(plain, F.lit(" Authorization: Bearer "), mixed)),
        (1, F.concat(plain, F.lit(" AKIA"), F.upper(F.substring(F.regexp_replace(mixed, "[^A-Za-z0-9]", "Q"), 1, 16)), F.lit(" key"))),
        (1, F.concat(secret, F.lit(" ghp_"), F.regexp_replace(F.substring(mixed, 1, 36), "[^A-Za-z0-9]", "x"))),
        (1, F.concat(plain, F.lit(" "), secret, sign, short)),
        (1, F.concat(secret, sign, short)),
        (1, F.concat(secret, sign, F.substring(code, 1, 8), F.lit("!"))),
        (1, F.concat(secret, sign, letters(20))),
        (1, F.concat(plain, F.lit(" "), letters(32))),
        (1, F.concat(plain, F.lit(" postgres://app:"), short, F.lit("@db.internal:5432/main"))),
        (1, F.concat(plain, F.lit(" https://deploy:"), letters(9), F.lit("@git.internal/x"))),
        (1, F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\n"), mixed, F.lit("\n-----END RSA PRIVATE KEY-----"))),
        (1, F.concat(plain, F.lit(" -----BEGIN PRIVATE KEY----- "), plain)),
        (1, F.concat(plain, F.lit("\n-----BEGIN EC PRIVATE KEY-----\n"), mixed)),
        (0, F.concat(secret, sign, plain_value)),
        (0, F.concat(secret, sign, plain_value, F.lit(";"))),
        (0, F.concat(secret, F.lit(": "), plain_value, F.lit(" "), plain)),
        (0, F.concat(pick("author|authority|secretary|Authors|tokens", 8), F.lit(": "), pick("Jonathan|Elisabeth|Maria-Theresia|several|Department|O'Connor|described|general", 9))),
        (0, F.concat(plain, F.lit(" "), word, F.lit("FromTheIndexOfPages "), plain)),
        (0, F.concat(harmless, sign, F.substring(code, 1, 40))),
        (0, F.concat(plain, F.lit(" "), harmless, F.lit(" "), code)),
        (0, F.concat(harmless, F.lit(" "), F.concat_ws("-", *(F.substring(code, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))))),
        (0, F.concat(plain, F.lit(" "), F.lpad(number, 16, "4"), F.lit(" "), plain)),
        (0, F.concat(plain, F.lit(" https://example.com/"), word, F.lit("/"), F.substring(number, 1, 4), F.lit(".html"))),
        (0, F.concat(plain, F.lit(" mail"), F.substring(number, 1, 5), F.lit(".user.name@mail.example.com"))),
        (0, F.concat(plain, F.lit(" "), word, F.substring(number, 1, 2), F.lit(" "), plain)),
        (0, F.concat(secret, sign, F.lit("your-example-key-1234567"))),
        (0, F.concat(secret, sign, F.lit("xxxxxxxxxxxxxxxx"), F.substring(number, 1, 2))),
        (0, F.concat(secret, sign, word, F.substring(number, 1, 1))),
        (0, F.concat(plain, F.lit(" 2024-01-"), F.substring(number, 1, 2), F.lit("T10:00:00.000 "), F.lit("1.2.3-2024.01.02-build"), plain)),
    )
    kind = F.pmod("id", F.lit(len(kinds)))
    text, label = F.lit(None).cast("string"), F.lit(None).cast("int")
    for k, (secret_kind, value) in enumerate(kinds):
        text, label = F.when(kind == k, value).otherwise(text), F.when(kind == k, secret_kind).otherwise(label)
    path = pick("src/main.py|docs/readme.md|config/settings.env|web/index.html|notes.txt", 6)
    return spark.range(rows).select(text.alias("text"), path.alias("path"), label.alias("label"))


def _vectors(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_features(found))


def train(labelled: DataFrame, params: SecretParams = SecretParams()) -> RandomForestClassificationModel:
    """A forest over the candidates of labelled findings (text, path, label 1 secret, 0 harmless; others left out)."""
    # Written first: the patterns would otherwise be put into one expression with what makes the findings.
    texts = shared_table(labelled.where("label IN (0, 1)").select("text", "path", "label"), "labelled")
    rows = _vectors(shared_table(candidates(texts), "labelled-candidates"))
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=params.trees, maxDepth=params.depth, seed=params.seed
    )
    rows = rows.select(F.col("label").cast("double"), "features").persist()  # the fit reads them several times
    try:
        return forest.fit(rows)
    finally:
        rows.unpersist()


def _scored(docs: DataFrame, model: RandomForestClassificationModel, params: SecretParams, *keys: str) -> DataFrame:
    """The keys, place, part, at, word, value, score, secret of every candidate of `docs` (keys, text and any path)."""
    path = F.col("path").cast("string") if "path" in docs.columns else F.lit("")
    texts = docs.select(*keys, "text", F.coalesce(path, F.lit("")).alias("path"))
    scored = model.transform(_vectors(shared_table(candidates(texts), "candidates")))
    score = F.round(vector_to_array("probability")[1], 9)
    places = (F.col(x).cast("long").alias(x) for x in ("place", "part", "at"))
    return scored.select(*keys, *places, "word", "value", score.alias("score"), (score >= params.threshold).alias("secret"))


def _model(docs: DataFrame, labelled: DataFrame | None, params: SecretParams) -> RandomForestClassificationModel:
    return train(labelled if labelled is not None else labelled_findings(docs.sparkSession, params.labelled), params)


def find_secrets(docs: DataFrame, labelled: DataFrame | None = None, params: SecretParams = SecretParams()) -> DataFrame:
    """doc_id, place, part, value, score (share of the forest), secret: one row for every candidate of every text.

    Null and empty texts have none; repeated rows give repeated findings; a null doc_id stays null.
    Columns other than `text` and `path` are not looked at. An empty table gives an empty one.
    """
    named = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    return _scored(named, _model(docs, labelled, params), params, "doc_id").drop("at", "word")


def _without_spans(spans: Column) -> Column:
    """The word less its spans (at, stop, put), which may overlap: what is put stands where one begins."""
    word, empty = F.col("word"), F.lit("")

    def step(done: Column, x: Column) -> Column:
        apart = x["at"] > done["upto"]
        kept = F.substring(word, done["upto"] + 1, F.greatest(x["at"] - 1 - done["upto"], F.lit(0)))
        text = F.concat(done["text"], kept, F.when(apart, x["put"]).otherwise(empty))
        return F.struct(text.alias("text"), F.greatest(x["stop"] - 1, done["upto"]).alias("upto"))

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("upto"))
    return F.aggregate(F.array_sort(spans), start, step, lambda x: F.concat(x["text"], F.substring(word, x["upto"] + 1, F.length(word))))


def _new_words(found: DataFrame, texts: DataFrame) -> DataFrame:
    """row, edits (place, word, joined) of every word that holds a part of a secret; `joined`: no gap before it."""
    shown, empty = F.lit("[SECRET]"), F.lit("")
    in_word = found.where("NOT startswith(value, '-----BEGIN')").select(
        "row", F.col("place").cast("int").alias("place"), "word", F.col("at").cast("int").alias("at"), (F.col("at") + F.length("value")).cast("int").alias("stop"),
        shown.alias("put"), F.lit(False).alias("joined"),
    )
    # A private key goes over several words: the first keeps what stands before it, the last what follows.
    blocks = found.where("startswith(value, '-----BEGIN')").select("row", "place", "at", F.split("value", _SPACE).alias("own"))
    blocks = blocks.join(texts.select("row", F.split("text", _SPACE).alias("words")), "row")
    blocks = blocks.select("row", "place", "at", F.size("own").alias("n"), F.posexplode(F.zip_with("own", F.slice("words", F.col("place").cast("int") + 1, F.size("own")), lambda x, y: F.struct(x.alias("own"), y.alias("words")))).alias("i", "x"))
    at = F.when(F.col("i") == 0, F.col("at").cast("int")).otherwise(1)
    in_blocks = blocks.select(
        "row", (F.col("place") + F.col("i")).cast("int").alias("place"), F.col("x.words").alias("word"), at.alias("at"), (at + F.length("x.own")).alias("stop"),
        F.when(F.col("i") == 0, shown).otherwise(empty).alias("put"), (F.col("i") > 0).alias("joined"),
    )
    spans = in_word.unionAll(in_blocks).groupBy("row", "place").agg(
        F.first("word").alias("word"), F.collect_list(F.struct("at", "stop", "put")).alias("spans"), F.bool_or("joined").alias("joined")
    )
    edits = spans.select("row", F.struct("place", _without_spans(F.col("spans")).alias("word"), "joined").alias("edit"))
    return edits.groupBy("row").agg(F.collect_list("edit").alias("edits"))


def redact(docs: DataFrame, labelled: DataFrame | None = None, params: SecretParams = SecretParams()) -> DataFrame:
    """`docs` with every secret replaced by [SECRET] where it was found, and `n_chars` as the new text has (if there is such a column).

    Findings that overlap become one mark; all other characters stay as they are, also an equal value
    elsewhere that is no finding. Each row is worked on alone, so doc_ids may repeat or be null.
    Null and empty texts stay; an empty table gives an empty one.
    """
    numbered = shared_table(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    path = [F.col("path").cast("string").alias("path")] if "path" in docs.columns else []
    texts = numbered.select(F.col("_row").alias("row"), "text", *path)
    found = shared_table(_scored(texts, _model(docs, labelled, params), params, "row").where("secret"), "secrets")
    joined = numbered.join(_new_words(found, texts).withColumnsRenamed({"row": "_row", "edits": "_edits"}), "_row", "left")
    # Words and edits in one order: an edit stands right after its word.
    words = F.transform(
        F.split("text", _SPACE), lambda x, i: F.struct(i.alias("place"), F.lit(0).alias("kind"), x.alias("word"), F.lit(False).alias("joined"))
    )
    edits = F.transform("_edits", lambda x: F.struct(x["place"], F.lit(1).alias("kind"), x["word"], x["joined"]))
    gaps = F.concat(F.array(F.lit("")), F.regexp_extract_all("text", F.lit(f"({_SPACE})"), F.lit(1)))
    edited = joined.where("_edits IS NOT NULL").withColumn("_all", F.array_sort(F.concat(words, edits))).withColumn("_gaps", gaps)

    def shown(x: Column, i: Column) -> Column:
        onward = F.get("_all", i + 1)
        new = F.coalesce(onward["kind"] == 1, F.lit(False))
        gap = F.when(new & onward["joined"], F.lit("")).otherwise(F.get("_gaps", x["place"]))
        return F.when(x["kind"] == 0, F.concat(gap, F.when(new, onward["word"]).otherwise(x["word"]))).otherwise("")

    edited = edited.withColumn("text", F.concat_ws("", F.transform("_all", shown)))
    if "n_chars" in docs.columns:
        edited = edited.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.where("_edits IS NULL").select(*docs.columns).unionAll(edited.select(*docs.columns))
