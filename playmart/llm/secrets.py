"""Secret scans: fixed patterns, and the entropy of sliding windows over candidate strings.

Candidates are runs of one character class. A window of `WIDTH` characters slides over each; its
Shannon entropy follows from the counts of the character that enters and the one that leaves, and
from nothing else, so a step costs the same for every window. Windows over their class's threshold
that look like a secret (digits among letters) are joined to spans, unless the allow list covers
the whole candidate. Only built-in DataFrame functions run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmart.session import scratch_path

# fixed values: the base patterns, in the order in which they are listed
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
BASE = ("assign", "access", "hex")
ACCESS = r"AKIA[A-Z0-9]{16,}"                       # 20 characters or more of a whole run
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
MIN_ASSIGNED = 6

WIDTH = 20          # characters of a window
CHUNK = 4096        # longer candidates are cut, with windows across the cuts kept
SCALE = 1_000_000_000
# class -> (run of its characters, bits per character from which a window counts: about the lowest
# hundredth of random windows of 16, 32 and 64 symbols; more symbols only have more). Runs that are
# hexadecimal throughout are in their own class alone
CLASSES = {
    "entropy_hex": (r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{20,}", 2.88),
    "entropy_base64": (r"(?<![A-Za-z0-9+/_=-])(?![0-9A-Fa-f]++(?![A-Za-z0-9+/_=-]))"
                       r"[A-Za-z0-9+/_=-]{20,}", 3.63),
    "entropy_lower": (r"(?<![a-z0-9])(?![0-9a-f]++(?![a-z0-9]))[a-z0-9]{20,}", 3.33),
    "entropy_upper": (r"(?<![A-Z0-9])(?![0-9A-F]++(?![A-Z0-9]))[A-Z0-9]{20,}", 3.33),  # base32 too
}
_DIGESTS = ((1, 40, 27), (256, 64, 43), (384, 96, 64), (512, 128, 86))
ALLOWED = (  # fixed values: whole candidates that look random and hold no secret in any part
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",   # identifiers
    "(?i)^(?:" + "|".join(rf"sha{n}[-_=](?:[0-9a-f]{{{h}}}|[a-z0-9+/_-]{{{b}}}={{0,2}})"
                          for n, h, b in _DIGESTS) + ")$",                    # integrity digests
    r"(?i)^(?:example|sample|placeholder|changeme|your|dummy|xxxxx|abcdefghij(?:klmnopqrstuvwxyz)?"
    r"|0123456789|1234567890|qwertyuiop|[+/_=-])++$",
    r"^[0-9+/_=-]+$",                                                         # numbers, rules
    # names and paths: parts of letters in one case, or with a first capital, and a short number
    r"^(?:(?:(?:[A-Z]?+[a-z]++|[A-Z]++)[0-9]{0,4}+|[0-9]++)(?![A-Za-z0-9])|[+/_=-])++$",
)
KINDS = (*BASE, *CLASSES)
MARK = "[SECRET]"    # stands in a text for a secret


def entries(text: Column, kind: int, pattern: str, group: int = 0, least: int = 0,
            keep: bool = False) -> Column:
    """Matches of a pattern in order: number, characters since the last match, own length, whether
    it counts, and its text if asked for. Nothing is matched twice where nothing matches."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(whole.alias("m"), checked.alias("c"),
                          F.split(text, pattern, -1).alias("g"))
    listed = F.transform(
        F.filter(zipped, lambda z: z["m"].isNotNull()),
        lambda z, k: F.struct(
            F.lit(kind).alias("kind"), k.alias("at"), F.char_length(z["g"]).alias("gap"),
            F.char_length(z["m"]).alias("size"), (F.char_length(z["c"]) >= least).alias("ok"),
            (z["m"] if keep else F.lit(None).cast("string")).alias("s")))
    empty = F.array().cast("array<struct<kind:int,at:int,gap:int,size:int,ok:boolean,s:string>>")
    return F.when(text.rlike(pattern), listed).otherwise(empty)


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per match, or one without a match, for every document: written once, so that `rid`
    names the same row in all that follows. `start` is in code points."""
    body = F.coalesce(docs[f"`{text}`"], F.lit(""))
    rows = docs.select(docs[f"`{key}`"].alias("doc"), F.xxhash64(body).alias("hash"),
                       F.monotonically_increasing_id().alias("rid"), body.alias("text"))
    text = F.col("text")
    found = F.concat(
        entries(text, 0, ASSIGN, 2, MIN_ASSIGNED), entries(text, 1, ACCESS), entries(text, 2, HEX),
        *[entries(text, len(BASE) + k, run, keep=True)
          for k, (run, _) in enumerate(CLASSES.values())])
    path = scratch_path(docs.sparkSession, "secrets")
    rows.select("doc", "hash", "rid", F.explode_outer(found).alias("e")).select(
        "doc", "hash", "rid", "e.*").write.parquet(path)
    matches = docs.sparkSession.read.parquet(path)
    # matches of one kind in one text
    until = Window.partitionBy("rid", "kind").orderBy("at").rowsBetween(
        Window.unboundedPreceding, 0)
    return matches.withColumn("start", F.sum(F.col("gap") + F.col("size")).over(until)
                              - F.col("size")).drop("gap", "at")


def steps() -> list[int]:
    """What one more of a character that already occurs n times adds to the sum of n log2 n."""
    f = [n * math.log2(n) if n else 0.0 for n in range(WIDTH + 2)]
    return [round((f[n + 1] - f[n]) * SCALE) for n in range(WIDTH + 1)]


def risky_windows(candidates: DataFrame) -> DataFrame:
    """`kind`, `s`, `from`, `to`: ranges of distinct candidate strings that windows of high entropy
    cover. `candidates` has one row per (kind, s). Candidates are numbered, and what goes on for each
    character is the number alone, so work and memory follow a candidate's length."""
    allowed = F.lit(False)
    for rule in ALLOWED:
        allowed = allowed | F.col("s").rlike(rule)
    mixed = F.col("s").rlike("[0-9]") & F.col("s").rlike("[A-Za-z]")
    path = scratch_path(candidates.sparkSession, "candidates")
    candidates.where(mixed & ~allowed).withColumn(
        "id", F.monotonically_increasing_id()).write.parquet(path)
    asked = candidates.sparkSession.read.parquet(path)
    stride = CHUNK - WIDTH + 1
    last = F.greatest(F.char_length("s") - WIDTH, F.lit(0))
    chunks = asked.select("kind", "id", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.floor(last / stride).cast("int")),
        lambda k: F.substring(F.col("s"), k * stride + 1, F.lit(CHUNK)))).alias("n", "part"))
    letters = chunks.select(
        "kind", "id", "n", F.posexplode(F.split("part", "")).alias("i", "c")).where("c <> ''")
    chunk = ["kind", "id", "n"]
    same = Window.partitionBy(*chunk, "c").orderBy("i")
    gain = F.array(*[F.lit(x) for x in steps()])
    pick = lambda n: F.element_at(gain, (n + 1).cast("int"))
    # equal characters among those before it that are still in the window when one enters, and in
    # the window that it opens, itself included, when it leaves
    events = letters.select(
        *chunk, "i", "c",
        pick(F.count(F.lit(1)).over(same.rangeBetween(-(WIDTH - 1), -1))).alias("enters"),
        pick(F.count(F.lit(1)).over(same.rangeBetween(0, WIDTH - 1)) - 1).alias("leaves"))
    order = Window.partitionBy(*chunk).orderBy("i")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    window = order.rowsBetween(-(WIDTH - 1), 0)
    change = events.withColumn("gone", F.coalesce(F.lag("leaves", WIDTH).over(order), F.lit(0)))
    summed = change.select(
        *chunk, "i", F.sum(F.col("enters") - F.col("gone")).over(upto).alias("sum"),
        F.max(F.col("c").rlike("[0-9]")).over(window).alias("digit"),
        F.max(F.col("c").rlike("[A-Za-z]")).over(window).alias("letter"))
    bits = F.lit(math.log2(WIDTH)) - F.col("sum") / F.lit(float(SCALE * WIDTH))
    least = F.lit(9.0)
    for k, (_, threshold) in enumerate(CLASSES.values()):
        least = F.when(F.col("kind") == len(BASE) + k, threshold).otherwise(least)
    high = summed.where((F.col("i") >= WIDTH - 1) & (bits >= least)
                        & F.col("digit") & F.col("letter"))
    # windows of a chunk that touch are one range
    apart = F.coalesce(F.col("i") - F.lag("i").over(order) > WIDTH, F.lit(True)).cast("int")
    ranges = high.withColumn("new", apart).withColumn("island", F.sum("new").over(upto)).groupBy(
        *chunk, "island").agg(
        (F.min("i") - (WIDTH - 1) + F.col("n") * stride).alias("from"),
        (F.max("i") + 1 + F.col("n") * stride).alias("to")).select("id", "from", "to")
    return ranges.join(asked.select("id", "kind", "s"), "id").select("kind", "s", "from", "to")


def entropy_spans(matches: DataFrame) -> DataFrame:
    """Spans of the entropy classes: each distinct candidate is judged once, whatever number of
    documents hold it, and its ranges join back; a hot candidate is split by the skew join."""
    runs = matches.where(F.col("kind") >= len(BASE))
    distinct = runs.select("kind", "s").distinct()
    risky = risky_windows(distinct).withColumnsRenamed({"kind": "_kind", "s": "_s"})
    placed = runs.join(risky, (F.col("kind") == F.col("_kind")) & (F.col("s") == F.col("_s"))
                       ).select("doc", "hash", "rid", "kind",
                                (F.col("start") + F.col("from")).alias("start"),
                                (F.col("start") + F.col("to")).alias("end"))
    return merged(placed, ["doc", "hash", "rid", "kind"])


def merged(spans: DataFrame, group: list[str]) -> DataFrame:
    """Joins spans of a group (of one text) that touch or overlap."""
    order = Window.partitionBy(*group).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("start") > reach, F.lit(True)).cast("int")
    return spans.withColumn("_new", new).withColumn(
        "_n", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy(
        *group, "_n").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_n")


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc`, `hash` (of the text), `rid` and `spans` (by start, then kind: start, kind number,
    end) of every row of `docs`, an empty array where there are none. Null texts are empty;
    repeated rows and null ids are rows of their own; other columns are not read."""
    matches = scan(docs, key, text)
    base = matches.select(
        "doc", "hash", "rid", F.when(F.col("ok") & (F.col("kind") < len(BASE)), F.struct(
            F.col("start").alias("start"), F.col("kind").alias("kind"),
            (F.col("start") + F.col("size")).alias("end"))).alias("span"))
    more = entropy_spans(matches).select("doc", "hash", "rid", F.struct("start", "kind", "end"))
    return base.unionAll(more).groupBy("rid").agg(
        F.first("doc").alias("doc"), F.first("hash").alias("hash"),
        F.array_sort(F.collect_list("span")).alias("spans"))


def spelled(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with every span replaced by `MARK`; spans that touch become one. All rows and
    columns stay, texts without a span as they are (null stays null)."""
    found = find_secrets(docs, key, text).where("size(spans) > 0")
    flat = found.select("doc", "hash", "rid", F.explode("spans").alias("s")).select(
        "doc", "hash", "rid", "s.start", "s.end")
    cuts = merged(flat, ["doc", "hash", "rid"]).groupBy("doc", "hash", "rid").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__secret_cuts")).select(
        F.col("doc").alias("__secret_doc"), F.col("hash").alias("__secret_hash"),
        "__secret_cuts").distinct()
    body = docs[f"`{text}`"]
    cond = docs[f"`{key}`"].eqNullSafe(cuts["__secret_doc"]) & (
        F.xxhash64(F.coalesce(body, F.lit(""))) == cuts["__secret_hash"])
    # what lies between two spans, from the end of one to the start of the next
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.col("__secret_cuts.end"))
    starts = F.concat(F.col("__secret_cuts.start"), F.array(F.char_length(body).cast("bigint")))
    between = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda z: F.substring(
        body, (z["a"] + 1).cast("int"), (z["b"] - z["a"]).cast("int")))
    clean = F.when(F.col("__secret_cuts").isNull(), body).otherwise(F.array_join(between, MARK))
    joined = docs.join(cuts, cond, "left")
    return joined.select(*[clean.alias(c) if c == text else docs[f"`{c}`"] for c in docs.columns])
