"""Secrets in texts: token-like candidates and values of credential names, judged by a random forest on their shape and surroundings.

Everything runs as DataFrame expressions; the forest is Spark ML's.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.plans.frontier import settled, written

#: A run of 12 or more token characters with a digit in it. Looking behind keeps a long run
#: from being tried at each of its characters.
CANDIDATE = r"(?<![A-Za-z0-9+/_.@-])(?=[A-Za-z+/_.@-]*+[0-9])[A-Za-z0-9+/_.@-]{12,}+={0,2}"
LEFT, RIGHT = 48, 24
#: Names that credentials are assigned to, and path words of material that is not live.
KEY_NAME = r"(?i)(token|secret|passw(or)?d|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential)"
#: What may stand between such a name and the sign or quote that follows: the rest of the name.
KEY_END = r"(?:key|value)?s?(?:[_.-][\w.-]*|[0-9]\w*)?[\"'`\]]{0,2}"
#: A quoted or assigned value next to such a name, as group 3, with or without a digit and of
#: any length. A quoted value ends at the next mark of its kind in the line.
NAMED = (
    KEY_NAME
    + KEY_END
    + r"(?:\s{0,8}(?::=|=>|={1,3}|:)\s{0,8}[\"'`]?|\s{1,8}[\"'`])(?![=:>])"
    + r"((?<=\")[^\"\r\n]+(?=\")|(?<=')[^'\r\n]+(?=')|(?<=`)[^`\r\n]+(?=`)|(?<![\"'`])[^\s\"'`]*[^\s\"'`,;.)\]}])"
)
SAMPLE_PATH = r"(?i)\b(tests?|examples?|samples?|mocks?|fixtures?|docs?|demo)\b"
#: Beginnings that issuers give to their tokens.
ISSUER = r"(?i)^(gh[po]_|akia|xox[bp]-|sk_live_|glpat-|eyj)"
WHOLE_WORD = r"(?<![\p{L}\p{N}])\p{L}{3,}(?![\p{L}\p{N}])"
MASK = "[SECRET]"

#: Bound of the labelled findings that the forest is fitted on.
LABELLED = 20_000
#: The dictionary holds the words found in this share of all documents, so their number is
#: bounded by the distinct words of a document over the share, whatever the number of documents.
DICTIONARY_SHARE = 0.005
TREES, DEPTH = 32, 10
#: Texts that findings are planted in, to learn from: every form once in each.
CONTEXTS = 400
#: One in so many of the planted findings is held out to measure by.
HELD_OUT = 4
THRESHOLD = 0.5

FEATURES = [
    "length", "digits", "uppers", "vowels", "hexes", "variety", "marks",
    "turns", "letter_digit", "digit_letter", "lower_upper", "same_class",
    "covered", "key_before", "key_near", "assigned", "quoted", "words_near",
    "in_url", "dotted", "has_at", "has_slash", "issuer", "sample_path",
]


def _starts(pieces: Column, found: Column) -> Column:
    """Where each of the matches ``found`` begins in the text that they split into ``pieces``."""
    return F.aggregate(
        F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, c: F.struct(F.length(p).alias("p"), F.length(c).alias("c"))),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda s, x: F.struct((s["at"] + x["p"] + x["c"]).alias("at"), F.concat(s["starts"], F.array(s["at"] + x["p"])).alias("starts")),
    )["starts"]


def candidates(docs: DataFrame, path: str | None = None, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc_id, start, candidate, before, after, left, right, path), one row per candidate of a text.

    Candidates are runs of 12 or more token characters with a digit (CANDIDATE), and values
    next to a credential's name (NAMED); of two that begin at one place the longer counts.
    start counts characters from 0. left and right are the LEFT and RIGHT characters of the
    text around a candidate; before and after are the same for values of NAMED, and end at the
    neighbouring run for runs. ``path`` names a column that says where a text lies; without it
    the path is empty. ``keys`` are the columns that name a text; they are given back with
    each of its candidates.
    """
    pieces, found, text = F.col("pieces"), F.col("found"), F.col("text")
    where = docs[path].cast("string") if path else F.lit("")
    rows = (
        docs.select(*[docs[k] for k in keys], docs["text"].alias("text"), F.coalesce(where, F.lit("")).alias("path"))
        .filter(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(NAMED))
        .select(
            *keys,
            "path",
            "text",
            F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
            F.split("text", CANDIDATE, -1).alias("pieces"),
            F.regexp_extract_all("text", F.lit(NAMED), F.lit(0)).alias("matches"),
            F.regexp_extract_all("text", F.lit(NAMED), F.lit(3)).alias("values"),
            F.split("text", NAMED, -1).alias("between"),
        )
        .withColumn("starts", _starts(pieces, found))
        .withColumn("match_starts", _starts(F.col("between"), F.col("matches")))
    )

    def placed(start: Column, candidate: Column, before: Column | None = None, after: Column | None = None) -> Column:
        left = F.substring(text, F.greatest(start - LEFT, F.lit(0)) + 1, F.least(start, F.lit(LEFT)))
        right = F.substring(text, start + F.length(candidate) + 1, F.lit(RIGHT))
        return F.struct(
            start.alias("start"),
            candidate.alias("candidate"),
            (left if before is None else before).alias("before"),
            (right if after is None else after).alias("after"),
            left.alias("left"),
            right.alias("right"),
        )

    runs = F.transform(
        found, lambda c, k: placed(F.col("starts")[k], c, F.right(pieces[k], F.lit(LEFT)), F.left(pieces[k + 1], F.lit(RIGHT)))
    )
    named = F.transform(
        F.col("values"), lambda v, k: placed(F.col("match_starts")[k] + F.length(F.col("matches")[k]) - F.length(v), v)
    )
    rows = rows.select(*keys, "path", runs.alias("runs"), named.alias("named"))

    def longer(other: Column, one: Column, equal: bool) -> Column:
        size, own = F.length(other["candidate"]), F.length(one["candidate"])
        return (other["start"] == one["start"]) & ((size >= own) if equal else (size > own))

    kept = F.concat(
        F.filter("runs", lambda r: ~F.exists("named", lambda n: longer(n, r, False))),
        F.filter("named", lambda n: ~F.exists("runs", lambda r: longer(r, n, True))),
    )
    return rows.select(*keys, "path", F.inline(kept))


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE) -> DataFrame:
    """(word): the words of three letters or more found in at least ``share`` of all documents."""
    total = docs.count()
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(docs["text"]), F.lit(WHOLE_WORD), F.lit(0)))).alias("word"))
    return words.groupBy("word").count().filter(F.col("count") >= share * total).select("word")


def coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """(candidate, letters): how many letters of a candidate belong to ``words``, for those with any."""
    parts = found.select("candidate").distinct().select("candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    return parts.join(F.broadcast(words), "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("letters"))


def features(found: DataFrame, words: DataFrame | list[str]) -> DataFrame:
    """``found`` with the columns of FEATURES, all doubles; ``words`` is a dictionary, as a table (word) or a list."""
    if isinstance(words, list):
        words = found.sparkSession.createDataFrame([(w,) for w in words], "word string")
    c, low = F.col("candidate"), F.lower("candidate")
    n = F.length(c)

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / n

    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "9"), "[^aB9]", "-")
    joined = found.join(settled(coverage(found, words)), "candidate", "left")
    columns = {
        "length": n,
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "vowels": share("[aeiouAEIOU]"),
        "hexes": share("[0-9a-fA-F]"),
        "variety": F.size(F.array_distinct(F.split(low, ""))) / n,
        "marks": share("[^A-Za-z0-9]"),
        "turns": F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) / n,
        "letter_digit": F.regexp_count(classes, F.lit("[aB](?=9)")) / n,
        "digit_letter": F.regexp_count(classes, F.lit("9(?=[aB])")) / n,
        "lower_upper": F.regexp_count(classes, F.lit("a(?=B)")) / n,
        "same_class": F.regexp_count(classes, F.lit(r"(.)(?=\1)")) / n,
        "covered": F.coalesce("letters", F.lit(0)) / n,
        "key_before": F.col("left").rlike(KEY_NAME + KEY_END + r"\W{1,6}$"),
        "key_near": F.col("left").rlike(KEY_NAME) | F.col("right").rlike(KEY_NAME),
        "assigned": F.col("left").rlike(r"[=:]\s*[\"'`]?$"),
        "quoted": F.col("left").rlike(r"[\"'`]$") & F.col("right").rlike(r"^[\"'`]"),
        "words_near": F.regexp_count(F.concat_ws(" ", "left", "right"), F.lit(r"\p{L}{2,}")),
        "in_url": F.col("left").rlike(r"(://\S*|www\.\S*)$") | c.rlike(r"^(www\.|//)"),
        "dotted": c.rlike(r"\."),
        "has_at": c.rlike("@"),
        "has_slash": c.rlike("/"),
        "issuer": c.rlike(ISSUER),
        "sample_path": F.col("path").rlike(SAMPLE_PATH),
    }
    return joined.select(*[found[k] for k in found.columns if k != "candidate"], c, *[v.cast("double").alias(k) for k, v in columns.items()])


def _forms(seed: Column, words: Column) -> list[tuple[str, int, Column, Column, str]]:
    """(form, label, what stands before, value, what stands after) of the findings to plant.

    ``seed`` gives the random characters, ``words`` are words of the text around.
    """

    def drawn(n: int, salt: str, kind: str = "alnum") -> Column:
        digest = F.sha2(F.concat_ws(":", seed, F.lit(salt)), 512)
        if kind == "hex":
            return F.left(digest, F.lit(n))
        if kind == "digits":
            return F.left(F.translate(digest, "abcdef", "193847"), F.lit(n))
        coded = F.base64(F.unhex(digest))
        if kind == "base64":
            return F.left(coded, F.lit(n))
        plain = F.left(F.regexp_replace(coded, "[^A-Za-z0-9]", ""), F.lit(n))
        return F.upper(plain) if kind == "upper" else plain

    def one_of(salt: str, *names: str) -> Column:
        return F.array(*[F.lit(n) for n in names])[F.pmod(F.xxhash64(seed, F.lit(salt)), F.lit(len(names))).cast("int")]

    name = one_of("name", "token", "secret", "api_key", "password", "access_key", "auth_token", "client_secret", "credential")
    number = lambda salt: F.pmod(F.xxhash64(seed, F.lit(salt)), F.lit(256)).cast("string")
    hyphened = F.concat_ws("-", F.slice(words, 1, 3))
    join, text = F.concat, F.lit
    return [
        ("assigned hex in double quotes", 1, join(name, text(' = "')), drawn(40, "a", "hex"), '"'),
        ("assigned letters in single quotes", 1, join(name, text(": '")), drawn(32, "b"), "'"),
        ("environment line", 1, join(F.upper(name), text("=")), drawn(40, "c", "base64"), "\n"),
        ("member of JSON", 1, join(text('"'), name, text('":"')), drawn(32, "d", "hex"), '",'),
        ("bearer", 1, text("Authorization: Bearer "), join(text("eyJ"), drawn(20, "e"), text("."), drawn(40, "f"), text("."), drawn(30, "g")), ""),
        ("token of a code host", 1, one_of("h", "use ", "with ", "", "clone by "), join(text("ghp_"), drawn(36, "h")), ""),
        ("key id of a cloud", 1, one_of("i", "key ", "as ", "", "id "), join(text("AKIA"), drawn(16, "i", "upper")), ""),
        ("live key of a payment service", 1, one_of("j", "pay ", "", "by "), join(text("sk_live_"), drawn(24, "j")), ""),
        ("token of a chat service", 1, one_of("k", "bot ", "", "by "), join(text("xoxb-"), drawn(12, "k", "digits"), text("-"), drawn(24, "l")), ""),
        ("password in an address", 1, join(one_of("m", "postgres", "mysql", "amqp", "https"), text("://admin:")), drawn(16, "m"), "@db.example.org/main"),
        ("assigned passphrase", 1, join(one_of("n", "password", "passphrase", "passwd"), text(' = "')), hyphened, '"'),
        ("assigned password", 1, join(one_of("o", "password", "pwd", "passwd"), text(': "')), drawn(12, "o"), '"'),
        ("commit", 0, one_of("p", "commit ", "at ", "revision ", ""), drawn(40, "p", "hex"), ""),
        ("checksum", 0, one_of("q", "sha256:", "checksum ", "md5 = "), drawn(64, "q", "hex"), ""),
        ("entity tag", 0, one_of("r", 'etag: "', 'hash = "', 'digest="'), drawn(32, "r", "hex"), '"'),
        ("unique id", 0, one_of("s", "id ", "request ", ""), join(drawn(8, "s", "hex"), text("-"), drawn(4, "t", "hex"), text("-4"), drawn(3, "u", "hex"), text("-"), drawn(12, "v", "hex")), ""),
        ("long number", 0, one_of("w", "order ", "", "no. ", "tokens: "), drawn(16, "w", "digits"), ""),
        ("host number", 0, one_of("x", "from ", "", "at "), join(text("1"), number("a"), text("."), number("b"), text(".10"), number("c"), text(".1"), number("d")), ""),
        ("mail address", 0, one_of("y", "to ", "", "auth "), join(words[0], text("."), drawn(3, "y", "digits"), text("@mail"), drawn(1, "z", "digits"), text(".example.com")), ""),
        ("time", 0, one_of("A", "on ", "", "token expires "), join(text("20"), drawn(2, "A", "digits"), text("-05-06T07:08:09.123Z")), ""),
        ("page address", 0, one_of("B", "see ", "", "auth: "), join(text("https://www.example.org/"), F.concat_ws("/", F.slice(words, 1, 2)), text("/article-"), drawn(5, "B", "digits")), ""),
        ("file name", 0, one_of("C", "in ", "", "secret in "), join(text("src/"), F.concat_ws("/", F.slice(words, 1, 2)), text("/module"), drawn(2, "C", "digits"), text(".py")), ""),
        ("words with a number", 0, one_of("D", "", "the "), join(hyphened, text("-"), drawn(3, "D", "digits")), ""),
        ("version", 0, one_of("E", 'version = "', 'release "'), join(text("1."), drawn(2, "E", "digits"), text(".3-beta4+build"), drawn(3, "F", "digits")), '"'),
        ("placeholder", 0, join(name, text(' = "')), one_of("G", "YOUR_API_KEY_HERE", "changeme", "<your-token-1>", "xxxxxxxxxxxx1234", "your_password", "None", "********"), '"'),
        ("reference", 0, join(name, text(" = ")), one_of("H", 'os.environ["DB_SECRET_1"]', "${API_TOKEN_1}", "config.get(name)", "settings.AUTH_TOKEN_2", "request.form.value1"), ""),
        ("prose", 0, join(one_of("I", "token", "password", "credentials", "secret", "authentication"), text(": ")), words[0], " "),
    ]


def planted(docs: DataFrame, path: str | None = None, contexts: int = CONTEXTS) -> DataFrame:
    """Findings whose label is known because they were put there, with the columns of ``candidates``.

    Credentials and false positives of every form of ``_forms`` are put into pieces of up to
    ``contexts`` of the texts, picked by a hash; one text in eight is in capitals. A credential
    in sample material (SAMPLE_PATH) counts as a false positive; one in eight is given such a
    path. More columns: form, label, and held_out for one finding in HELD_OUT.
    """
    text, place = docs["text"], F.xxhash64(docs["text"])
    at = F.pmod(place, F.greatest(F.length(text) - 100, F.lit(1))) + 1
    where = F.coalesce(docs[path].cast("string"), F.lit("")) if path else F.lit("")
    # A hash of the text picks about 20 rows for each wanted one; copies then count once.
    few = F.pmod(place, F.lit(1 << 40)) < min(1.0, 20 * contexts / max(1, docs.count())) * (1 << 40)
    pieces = (
        docs.filter(text.isNotNull() & few)
        .select(place.alias("place"), F.substring(text, at.cast("int"), F.lit(100)).alias("piece"), where.alias("path"))
        .distinct()
        .orderBy("place", "piece", "path")
        .limit(contexts)
    )
    cut = pieces.select(
        "place",
        "path",
        F.regexp_replace(F.left("piece", F.lit(60)), r"\S*$", "").alias("l"),
        F.regexp_replace(F.substring("piece", 61, 40), r"^\S*", "").alias("r"),
    )
    words = F.concat(F.regexp_extract_all("l", F.lit(r"(?<!\p{L})\p{L}{3,12}(?!\p{L})"), F.lit(0)), F.array(*[F.lit(w) for w in ("winter", "table", "paper")]))
    forms = [
        F.struct(F.lit(f).alias("form"), F.lit(y).alias("label"), before.alias("lead"), value.alias("value"), F.lit(after).alias("tail"))
        for f, y, before, value, after in _forms(F.concat_ws("|", "place", "l"), words)
    ]
    rows = cut.select("place", "path", "l", "r", F.inline(F.array(*forms)))
    draw = F.xxhash64("place", "l", "form")
    whole = F.concat("l", "lead", "value", "tail", "r")
    sample = F.pmod(draw, F.lit(8)) == 1
    texts = rows.select(
        draw.alias("doc_id"),
        F.when(F.pmod(draw, F.lit(64)) < 8, F.upper(whole)).otherwise(whole).alias("text"),
        F.when(sample, F.concat("path", F.lit(" tests/fixtures"))).otherwise(F.col("path")).alias("path"),
        "form",
        "label",
        (F.length("l") + F.length("lead")).alias("first"),
        F.length("value").alias("size"),
    )
    keys = ("doc_id", "form", "label", "first", "size")
    found = candidates(settled(texts), "path", keys)
    shared = F.least(F.col("start") + F.length("candidate"), F.col("first") + F.col("size")) - F.greatest("start", "first")
    judged = F.when(F.col("path").rlike(SAMPLE_PATH), 0).otherwise(F.col("label"))
    return (
        found.filter(2 * shared >= F.col("size"))
        .withColumn("label", judged)
        .withColumn("held_out", F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(HELD_OUT)) == 0)
        .drop("first", "size")
    )


def planted_quality(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(form, label, findings, flagged) of the held-out planted findings, by the forest of the others."""
    known = settled(features(settled(planted(docs, path)), dictionary(docs)))
    model = train(known.filter("NOT held_out"))
    tested = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(known.filter("held_out"))
    flagged = vector_to_array(F.col("probability"))[1] >= THRESHOLD
    return model.transform(tested).groupBy("form", "label").agg(F.count(F.lit(1)).alias("findings"), F.count_if(flagged).alias("flagged"))


def train(labelled: DataFrame, bound: int = LABELLED) -> RandomForestClassificationModel | None:
    """A forest from rows with FEATURES and ``label`` (0 or 1); None unless both labels occur.

    At most about ``bound`` rows are used, taken by a hash of the finding's place and text.
    The rows used are put in one order, so the same rows give the same forest.
    """
    rows = labelled.filter("label IS NOT NULL")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    place = F.xxhash64("doc_id", "start", "candidate")
    share = F.when(F.col("label") == 1, min(1.0, bound / 2 / counts[1])).otherwise(min(1.0, bound / 2 / counts[0]))
    used = rows.filter(F.pmod(place, F.lit(1 << 40)) < share * (1 << 40)).select(*FEATURES, F.col("label").cast("double"), place.alias("place"))
    used = used.repartition(1).sortWithinPartitions("place", *FEATURES)
    forest = RandomForestClassifier(featuresCol="vector", numTrees=TREES, maxDepth=DEPTH, seed=17, maxBins=32)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(used))


def scan(docs: DataFrame, path: str | None = None, labelled: DataFrame | None = None, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc_id, start, length, candidate, score, is_secret), one row per candidate; ``keys`` as in ``candidates``.

    ``labelled`` (doc_id, start, label) names findings of these texts that people judged; without
    it, or if it lacks one of the labels, the forest learns from ``planted`` findings, whose
    labels owe nothing to the features. The forest scores every candidate. If there is no text
    to plant in, all scores are 0. Texts that are NULL, empty or without candidates give no row;
    a repeated row gives its rows again; a NULL doc_id stays NULL. Other columns are not read.
    """
    words = settled(dictionary(docs))
    found = settled(candidates(docs, path, keys))
    known = features(found, words)
    model = None
    if labelled is not None:
        model = train(known.join(labelled.select("doc_id", "start", "label").distinct(), ["doc_id", "start"]))
    if model is None:
        model = train(features(settled(planted(docs, path)), words).filter("NOT held_out"))
    if model is None:
        scored = known.withColumn("score", F.lit(0.0))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(known)
        scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        *keys, "start", F.col("length").cast("int").alias("length"), "candidate", "score", (F.col("score") >= THRESHOLD).alias("is_secret")
    )


def cut_out(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with the characters at ``spans`` (start, length), sorted by start, replaced by a mask.

    Spans that overlap become one mask; all other characters stay as they are.
    """
    begun = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def cut(state: Column, span: Column) -> Column:
        new = span["start"] >= state["at"]
        between = F.concat(F.substring(text, state["at"] + 1, span["start"] - state["at"]), F.lit(mask))
        return F.struct(
            F.concat(state["done"], F.when(new, between).otherwise("")).alias("done"),
            F.greatest(state["at"], span["start"] + span["length"]).alias("at"),
        )

    return F.aggregate(spans, begun, cut, lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text))))


def without_secrets(docs: DataFrame, path: str | None = None, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with every confirmed secret replaced by a mask at the place where it was found.

    All rows, columns and other characters stay. Each row is searched and masked by itself: a
    number written beside the rows tells them apart, so rows that repeat a doc_id or have none
    share nothing. ``path`` and ``labelled`` are those of ``scan``.
    """
    numbered = written(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row")))
    where = F.col("doc")[path] if path else F.lit("")
    texts = numbered.select(F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"), where.alias("path"), "row")
    spans = (
        scan(texts, "path", labelled, ("doc_id", "row"))
        .filter("is_secret")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans"))  # of one text
    )
    text = F.when(F.col("spans").isNull(), F.col("doc.text")).otherwise(cut_out(F.col("doc.text"), F.col("spans")))
    joined = numbered.join(spans, "row", "left")
    return joined.select(*[text.alias("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])
