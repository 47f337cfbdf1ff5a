"""Secret scan with multipart credential linking, in DataFrame functions only.

Base finds (kinds assign, access, hex) are reported wherever they stand. Weak
candidates are parts of a credential that mean little alone: a login name, a
short assigned value, a 40-character key, an address. Every part has a role
(identifier, secret or endpoint) and a scope, its span widened by ``SCOPE`` code
points on both sides. An interval join of parts within documents, on (row, scope
bucket) and overlap, finds which roles meet in a scope:

* an identifier candidate counts if a secret part lies in its scope,
* a secret candidate counts if an identifier part lies in its scope,
* an endpoint counts if both do.

Candidates that overlap a base find are part of it and not reported again. Parts
of one kind don't overlap, so a bucket holds a bounded number of them and no
pair beyond a bucket is formed.

Spans are code points, end exclusive. A find's start follows from the texts that
the pattern splits off before it, summed in a window over the document's finds.

Null or empty text: no finds. Null doc_id and repeated rows: each row is
returned with its own finds. Very long texts: searched whole, in one row; only their
finds go on. Empty table: no rows. Extra columns are ignored by
:func:`scan` and kept by :func:`redact`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.llm.common import written

#: Fixed patterns. Letters of the assignment's keyword stand in either case.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


VALUE = r"[A-Za-z0-9+/_.=-]+"
ASSIGNED = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = f"({'|'.join(map(either_case, KEYWORDS))}){ASSIGNED}({VALUE})"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Weak candidates of the method.
NAMES = ("username", "user", "login", "client_?id", "account")
LOGIN = f"({'|'.join(map(either_case, NAMES))}){ASSIGNED}([A-Za-z0-9@+_.-]+)"
KEY = r"[A-Za-z0-9+/]{40,}"
ENDPOINT = r"""https?://[^\x00-\x20"'<>]+"""

#: kind -> (order in lists, role, base find)
KINDS = {"assign": (0, "secret", True), "access": (1, "identifier", True), "hex": (2, "secret", True),
         "login": (3, "identifier", False), "short": (4, "secret", False), "key": (5, "secret", False), "endpoint": (6, "endpoint", False)}
LEAST_VALUE, LEAST_SHORT, LEAST_NAME, KEY_LENGTH = 8, 4, 3, 40
SCOPE = 200


def kind_of_assign(value: Column) -> Column:
    n = F.length(value)
    return F.when(n >= LEAST_VALUE, "assign").when(n >= LEAST_SHORT, "short").otherwise("none")


def parts(docs: DataFrame) -> DataFrame:
    """One row per document, as a written table: row_id, doc_id, text_hash and
    the arrays of finds by pattern. The texts are read once."""
    def every(pattern: str) -> Column:
        return F.regexp_extract_all("text", F.lit(pattern), F.lit(0))

    def any_of(*names: str) -> Column:
        out = F.lit(False)
        for n in names:
            out = out | (F.size(n) > 0)
        return out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.select("*", every(ASSIGN).alias("assign"), every(ACCESS).alias("access"), every(HEX).alias("hex"), every(LOGIN).alias("login"))
    # a key needs an identifier beside it, an address both roles
    found = found.select("*", F.when(any_of("access", "login"), every(KEY)).alias("key"))
    found = found.select("*", F.when(any_of("access", "login") & any_of("assign", "hex", "key"), every(ENDPOINT)).alias("endpoint"))
    text = F.col("text")
    values = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))
    names = F.regexp_extract_all("text", F.lit(LOGIN), F.lit(2))

    def with_value(found_in: str, pattern: str, value: Column, named) -> Column:
        gaps = F.split(text, pattern, -1)
        return F.when(F.size(found_in) > 0, F.transform(F.arrays_zip(F.col(found_in).alias("x"), value.alias("v"), F.slice(gaps, 1, F.size(found_in)).alias("g")),
                                                       lambda z: F.struct(named(z["v"]).alias("kind"), F.length(z["g"]).alias("gap"), F.length(z["x"]).alias("len"))))

    def plain(found_in: str, pattern: str, ok=None) -> Column:
        gaps = F.split(text, pattern, -1)
        kind = (lambda x: F.when(ok(x), found_in).otherwise("none")) if ok else (lambda x: F.lit(found_in))
        return F.when(F.size(found_in) > 0, F.transform(F.arrays_zip(F.col(found_in).alias("x"), F.slice(gaps, 1, F.size(found_in)).alias("g")),
                                                       lambda z: F.struct(kind(z["x"]).alias("kind"), F.length(z["g"]).alias("gap"), F.length(z["x"]).alias("len"))))

    arrays = {
        "assign": with_value("assign", ASSIGN, values, kind_of_assign), "access": plain("access", ACCESS), "hex": plain("hex", HEX),
        "login": with_value("login", LOGIN, names, lambda v: F.when(F.length(v) >= LEAST_NAME, "login").otherwise("none")),
        "key": plain("key", KEY, lambda x: F.length(x) == KEY_LENGTH), "endpoint": plain("endpoint", ENDPOINT)}
    return written(found.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", F.xxhash64("text").alias("text_hash"), F.length("text").alias("n_chars"),
                                *[a.alias(n) for n, a in arrays.items()]), "secret-parts")


def spans(rows: DataFrame) -> DataFrame:
    """(row_id, kind, role, base, start, end) of all parts of written ``rows``."""
    out = None
    for name in ("assign", "access", "hex", "login", "key", "endpoint"):
        one = rows.where(F.col(name).isNotNull()).select("row_id", F.lit(name).alias("found_by"), F.posexplode(name).alias("at", "x")).select("row_id", "found_by", "at", "x.*")
        out = one if out is None else out.unionByName(one)
    upto = Window.partitionBy("row_id", "found_by").orderBy("at")
    end = F.sum(F.col("gap") + F.col("len")).over(upto)
    placed = out.withColumn("end", end).withColumn("start", F.col("end") - F.col("len")).where("kind <> 'none'")
    def of_kind(pick) -> Column:
        return F.create_map(*[F.lit(x) for kind, facts in KINDS.items() for x in (kind, pick(facts))])[F.col("kind")]

    return placed.select("row_id", "kind", of_kind(lambda f: f[0]).alias("nth"), of_kind(lambda f: f[1]).alias("role"), of_kind(lambda f: f[2]).alias("base"), "start", "end")


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak candidates of ``found`` whose complementary parts lie in scope."""
    def buckets(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / scope).cast("long"), F.floor(high / scope).cast("long")))

    key = ["row_id", "kind", "nth", "role", "start", "end"]
    weak = found.where("not base").select(*key, buckets(F.col("start") - scope, F.col("end") + scope).alias("bucket"))
    others = found.select(F.col("row_id").alias("o_row"), F.col("kind").alias("o_kind"), F.col("role").alias("o_role"), F.col("base").alias("o_base"),
                          F.col("start").alias("o_start"), F.col("end").alias("o_end"), buckets(F.col("start"), F.col("end") - 1).alias("o_bucket"))
    meet = ((F.col("row_id") == F.col("o_row")) & (F.col("bucket") == F.col("o_bucket")) & (F.col("o_start") < F.col("end") + scope) & (F.col("o_end") > F.col("start") - scope)
            & ((F.col("kind") != F.col("o_kind")) | (F.col("start") != F.col("o_start"))))
    inside = F.col("o_base") & (F.col("o_start") < F.col("end")) & (F.col("o_end") > F.col("start"))
    roles = (weak.join(others, meet).groupBy(*key)
             .agg(F.max(F.col("o_role") == "secret").alias("secret"), F.max(F.col("o_role") == "identifier").alias("identifier"), F.max(inside).alias("inside")))
    counts = (F.when(F.col("role") == "identifier", F.col("secret")).when(F.col("role") == "secret", F.col("identifier")).otherwise(F.col("secret") & F.col("identifier")))
    return roles.where(counts & ~F.col("inside")).select(*key)


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """For every row of ``docs``: doc_id, text_hash, n_assign, n_access, n_hex,
    and base and all, sorted arrays of (start, nth, kind, end, before: the furthest end
    of the spans listed earlier)."""
    rows = parts(docs)
    found = written(spans(rows), "secret-spans")
    everything = found.where("base").select("row_id", "start", "nth", "kind", "end", "base").unionByName(
        linked(found, scope).select("row_id", "start", "nth", "kind", "end", F.lit(False).alias("base")))
    earlier = Window.partitionBy("row_id").orderBy("start", "nth", "end").rowsBetween(Window.unboundedPreceding, -1)
    everything = everything.withColumn("before", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    item = F.struct("start", "nth", "kind", "end", "before")

    def number(kind: str) -> Column:
        return F.count(F.when(F.col("kind") == kind, 1)).alias(f"n_{kind}")

    by_row = everything.groupBy("row_id").agg(number("assign"), number("access"), number("hex"), F.sort_array(F.collect_list(F.when(F.col("base"), item))).alias("base"), F.sort_array(F.collect_list(item)).alias("all"))
    return (rows.select("row_id", "doc_id", "text_hash").join(by_row, "row_id", "left")
            .select("doc_id", "text_hash", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")], "base", "all"))


def listed(spans_of: str) -> Column:
    """kind:start:end, comma-joined; no spans: an empty text."""
    return F.coalesce(F.array_join(F.transform(spans_of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","), F.lit(""))


def redact(docs: DataFrame, scope: int = SCOPE, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mask``; n_chars, where
    there is one, follows the text. Overlapping spans are masked as one."""
    found = scan(docs, scope).where(F.size("all") > 0).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("all").alias("spans")).dropDuplicates(["id", "hash"])
    rows = docs.select(F.struct(*docs.columns).alias("row"))  # the columns' own names can't clash
    text = F.col("row.text").cast("string")

    def piece(s: Column) -> Column:
        # a span that begins inside an earlier one adds no mask of its own
        low, before = s["start"].cast("int"), s["before"].cast("int")
        return F.when(low < before, F.lit("")).otherwise(F.concat(F.substring(text, before + 1, low - before), F.lit(mask)))

    furthest = F.greatest(F.element_at("spans", -1)["end"], F.element_at("spans", -1)["before"]).cast("int")
    tail = F.substring(text, furthest + 1, F.length(text))
    masked = F.concat(F.array_join(F.transform("spans", piece), ""), tail)
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("hash"))
    out = rows.join(found, same, "left").withColumn("masked", F.when(F.col("spans").isNotNull(), masked))
    new = {"text": F.coalesce("masked", "row.text"), "n_chars": F.coalesce(F.length("masked").cast("long"), "row.n_chars") if "n_chars" in docs.columns else None}
    return out.select(*[(new[c] if new.get(c) is not None else F.col("row")[c]).alias(c) for c in docs.columns])
