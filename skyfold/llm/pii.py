"""Personal data: fixed patterns as seeds, bootstrapped contexts for the rest.

Base spans (email, ip, card, phone) come from regular expressions over whole
texts. They are the seeds of a bootstrap. An instance is a whole base span, or
a run of identifier-like tokens (those with a digit or an @) that no base span
touches, so '0301 234567' is one instance; numbers are compared by their
digits. The two words before an instance are a lexical pattern (an earlier
token counts as a word <num> or <mail>, the start of the text as ^), and
patterns and instances form a graph. A pattern's confidence for a kind is the mean
score of the different instances it precedes; an instance scores one if it is a
seed and otherwise the noisy-or of its patterns. In every round the patterns
with enough accepted instances and confidence accept the instances they precede,
which may in turn lead to further patterns; the rounds end with one that adds neither. Every
occurrence of an accepted instance that no base span touches is added as a span of that kind.

Everything is DataFrame and SQL functions. A text is split into matches and
the gaps between them in one go; places, contexts and overlaps are running
aggregates over these rows in the order of the text, so the time grows with
the length of a text and not with its square. Only matches are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.common import cut, materialise, packed_row, quoted

KINDS = ("email", "ip", "card", "phone")
TAGS = {k: f"[{k.upper()}]" for k in KINDS}

# The patterns of the four kinds. Possessive quantifiers and look-behinds keep
# matching linear on long runs; they find the same matches as the plain forms:
# a match starts at the first character of its run, or (email) right after the
# match before.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Tokens that may go on after a blank, and tokens that may go on from the one before: the groups of one number.
GOES_ON = r"^[(+\[]*[0-9][0-9().-]*(?<=[0-9)])$"
GOES_WITH = r"^\(?[0-9][0-9().-]*\p{Punct}*$"
#: The longest number of the four kinds has so many digits; the tokens of longer runs stand alone.
MOST_DIGITS = 19
#: A text without these has no span and no identifier-like token.
ANY = "[0-9@]"
#: A changed text is put together from stretches of so many characters.
STRETCH = 4096


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _valid(kind: str, m: str) -> str:
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    if kind == "ip":
        return (f"forall(transform(split({m}, '[.]'), p -> regexp_replace(p, '^0+', '')), "
                "p -> length(p) <= 3 AND coalesce(try_cast(p AS int), 0) <= 255)")
    if kind == "phone":
        return f"length({digits}) BETWEEN 9 AND 15"
    if kind == "card":
        luhn = (f"aggregate(transform(split(reverse({digits}), ''), (d, i) -> CASE WHEN i % 2 = 0 THEN CAST(d AS int) "
                "WHEN CAST(d AS int) > 4 THEN CAST(d AS int) * 2 - 9 ELSE CAST(d AS int) * 2 END), 0, "
                "(a, d) -> a + coalesce(d, 0)) % 10 = 0")
        return f"CASE WHEN length({digits}) BETWEEN 12 AND 19 THEN {luhn} ELSE false END"
    return "true"


def _split(kind: str) -> str:
    """SQL: array of (gap, m, words) of the matches in _t: the length of the gap before each, its
    text, and for tokens the last two words of the gap and whether it is one blank."""
    pattern = PATTERNS.get(kind, TOKEN)
    token = kind == "token"
    words = _last_words("g") if token else "CAST(NULL AS array<string>)"
    near = "g IN (' ', '\t')" if token else "false"
    # The last gap has no match after it.
    return (f"filter(zip_with(split(_t, {_lit(pattern)}, -1), regexp_extract_all(_t, {_lit(pattern)}, 0), (g, x) -> "
            f"named_struct('kind', '{kind}', 'gap', length(g), 'm', x, 'words', CASE WHEN x IS NOT NULL THEN {words} END, "
            f"'near', {near})), z -> z.m IS NOT NULL)")


_MATCHES = "array<struct<kind:string,gap:int,m:string,words:array<string>,near:boolean>>"


def matches(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, items): ``rows`` (row, id, th) of all documents, th a hash of the text;
    ``items`` (row, kind, s, e, m, words, near): the matches of the five expressions that
    pass their kind's check, in code points, end exclusive. Matches that fail (address parts over
    255, wrong digit count or check digit) are dropped without a retry.

    Both are written tables, so a row keeps its number.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    trigger = {"email": "_t LIKE '%@%'", "phone": "_t LIKE '%+%'"}
    found = [f"CASE WHEN {trigger.get(k, 'true')} THEN {_split(k)} ELSE CAST(array() AS {_MATCHES}) END"
             for k in (*KINDS, "token")]
    some = F.col("_t").rlike(ANY)
    texts = materialise(texts.select(
        "id", F.xxhash64("_t").alias("th"), F.monotonically_increasing_id().alias("row"),
        F.when(some, F.expr(f"filter(array({', '.join(found)}), a -> size(a) > 0)")).alias("found")), "pii_matches")
    each = texts.filter("size(found) > 0").select("row", F.explode("found").alias("one")).select(
        "row", F.posexplode("one").alias("i", "x")).select("row", "i", "x.*").repartition(F.col("row"))
    before = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("m")).over(before).cast("int")
    valid = F.expr("CASE " + " ".join(f"WHEN kind = '{k}' THEN {_valid(k, 'm')}" for k in KINDS) + " ELSE true END")
    items = each.withColumn("e", end).select(
        "row", "kind", (F.col("e") - F.length("m")).alias("s"), "e", "m", "words", "near", valid.alias("valid"))
    return texts.select("row", "id", "th"), materialise(items.filter("valid").drop("valid"), "pii_items")


def _words(text: str) -> str:
    return f"filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w != '')"


def _last_words(gap: str) -> str:
    """The last two words of a gap, lower-cased, without punctuation; a long gap is read whole if its end lacks them."""
    near = _words(f"right({gap}, 200)")
    # The first word of a cut gap may be a part of one, so there must be a third.
    words = f"CASE WHEN length({gap}) <= 200 OR size({near}) > 2 THEN {near} ELSE {_words(gap)} END"
    return f"transform(array({words}), w -> slice(w, greatest(size(w) - 1, 1), 2))[0]"


def _with_contexts(tokens: DataFrame) -> DataFrame:
    """Tokens (row, s, e, m, near) with ``left``, the two words before each.

    The words run on across earlier tokens, which count as a word <num> or
    <mail> (alike ones side by side as one); ^ stands for the start of the text.
    """
    order = Window.partitionBy("row").orderBy("s")
    mark = F.when(F.col("m").contains("@"), "<mail>").otherwise("<num>")
    tokens = tokens.withColumn("mark", mark).withColumn("last_mark", F.lag("mark").over(order))
    # What stands before this token's own mark; a mark beside an equal one does not count.
    repeats = (F.size("words") == 0) & F.col("mark").eqNullSafe(F.col("last_mark"))
    ahead = F.when(~repeats, F.coalesce(F.element_at(F.when(F.size("words") > 0, F.col("words")), -1), "last_mark", F.lit("^")))
    earlier = F.last(ahead, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    two = F.concat(F.array(F.coalesce(earlier, F.lit("^")), F.coalesce("last_mark", F.lit("^"))), "words")
    return tokens.withColumn("left", F.array_join(F.slice(two, -2, 2), " ")).drop("mark", "last_mark", "words")


def _value(text: str) -> str:
    """How an instance is compared: numbers other than addresses by their digits, the rest in lower case, trimmed."""
    trimmed = f"lower(regexp_replace({text}, '^[^\\\\p{{L}}\\\\p{{N}}+(]+|[^\\\\p{{L}}\\\\p{{N}}]+$', ''))"
    return (f"CASE WHEN {text} RLIKE '[\\\\p{{L}}@]' OR {trimmed} RLIKE '^[0-9]+([.][0-9]+){{3}}$' THEN {trimmed} "
            f"ELSE regexp_replace({text}, '[^0-9]', '') END")


def instances(items: DataFrame) -> DataFrame:
    """(row, s, e, pattern, value, seed_of): the base spans, and the runs of tokens that no base span touches."""
    is_token = F.col("kind") == "token"
    places = F.struct("s", "e", "left")
    rows = _with_contexts(items.filter(is_token).drop("kind")).withColumn("kind", F.lit("token")).unionByName(
        items.filter(~is_token).drop("words", "near"), allowMissingColumns=True).repartition(F.col("row"))
    up_to = Window.partitionBy("row").orderBy("s").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy("row").orderBy(F.desc("s")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # Of spans that start up to a token's start the last end, of those from there on the first start;
    # of tokens that start up to a span's start the last.
    rows = rows.withColumns({"reach": F.max(F.when(~is_token, F.col("e"))).over(up_to),
                             "at": F.max(F.when(is_token, places)).over(up_to),
                             "next": F.min(F.when(~is_token, F.col("s"))).over(back)})
    seeds = rows.filter(~is_token).filter(F.col("at.e") > F.col("s")).select(
        "row", "s", "e", F.col("m").alias("token"), F.col("at.left").alias("left"), F.col("kind").alias("seed_of"))
    touched = F.coalesce(F.col("reach") > F.col("s"), F.lit(False)) | F.coalesce(F.col("next") < F.col("e"), F.lit(False))
    free = rows.filter(is_token & ~touched).select("row", "s", "e", "m", "near", "left")
    # Each token joins the run before it or starts one; runs too long for one number fall back to their tokens.
    order = Window.partitionBy("row").orderBy("s")
    goes_on = (F.col("near") & (F.lag("e").over(order) + 1 == F.col("s")) & F.lag("m").over(order).rlike(GOES_ON)
               & F.col("m").rlike(GOES_WITH))
    free = free.withColumn("starts", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    free = free.withColumn("run", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    within = Window.partitionBy("row", "run")
    free = free.withColumn("digits", F.sum(F.length(F.regexp_replace("m", "[^0-9]", ""))).over(within))
    alone = F.col("digits") > MOST_DIGITS
    runs = free.withColumn("run", F.when(alone, -F.col("s") - 1).otherwise(F.col("run"))).groupBy("row", "run").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.array_sort(F.collect_list(F.struct("s", "m", "left"))).alias("t"))
    runs = runs.select("row", "s", "e", F.array_join("t.m", " ").alias("token"), F.expr("t[0].left").alias("left"),
                       F.lit(None).cast("string").alias("seed_of"))
    telling = F.col("token").contains("@") | (F.length(F.regexp_replace("token", "[^0-9]", "")) >= 4)
    return seeds.unionByName(runs.filter(telling)).select(
        "row", "s", "e", F.col("left").alias("pattern"), F.expr(_value("token")).alias("value"), "seed_of")


def discover(items: DataFrame, min_support: int = 5, min_confidence: float = 0.7) -> DataFrame:
    """(row, kind, s, e) of the spans the bootstrap adds to the base spans.

    A pattern needs ``min_support`` different accepted instances of a kind and a confidence
    of ``min_confidence``; an added instance needs four digits or an @ and that
    confidence too.
    """
    token = materialise(instances(items), "pii_instances")
    accepted = bootstrap(token, min_support, min_confidence)
    # Of several kinds the best score; ties by the order of KINDS.
    rank = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    kinds = accepted.groupBy("value").agg(F.max(F.struct("score", (-rank).alias("r"), "kind")).alias("best")).select(
        "value", F.col("best.kind").alias("kind"))
    return token.filter("seed_of IS NULL").join(kinds, "value").select("row", "kind", "s", "e")


def bootstrap(token: DataFrame, min_support: int, min_confidence: float) -> DataFrame:
    """(value, kind, score) of the accepted instances of ``token`` (pattern, value, seed_of)."""
    edges = cut(token.select("pattern", "value").distinct())
    total = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("of"))
    accepted = cut(token.filter("seed_of IS NOT NULL").select(
        "value", F.col("seed_of").alias("kind"), F.lit(1.0).alias("score")).distinct())
    seeds = accepted
    known = None
    while True:
        confidence = F.col("sum") / F.col("of")
        patterns = cut(edges.join(accepted, "value").groupBy("pattern", "kind").agg(
            F.count(F.lit(1)).alias("support"), F.sum("score").alias("sum")).filter(F.col("support") >= min_support)
            .join(total, "pattern").filter(confidence >= min_confidence).select(
                "pattern", "kind", confidence.alias("confidence")))
        doubt = F.greatest(F.lit(1e-9), 1 - F.col("confidence"))
        found = patterns.join(edges, "pattern").groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log(doubt)))).alias("score"))
        # Every pattern here is confident, so each instance it precedes reaches the confidence too.
        accepted = cut(found.unionByName(seeds).groupBy("value", "kind").agg(F.max("score").alias("score")))
        now = patterns.count(), accepted.count()
        if now == known:
            return accepted
        known = now


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_support: int = 5,
         min_confidence: float = 0.7) -> DataFrame:
    """One row per document: id, th (a hash of the text), one array of base spans (s, e) per kind, added spans.

    ``added`` holds (s, e, kind). Null texts are empty and have no spans;
    repeated rows come back repeated; null ids are allowed; long texts are read whole. Extra columns are
    ignored.
    """
    rows, items = matches(docs, id_col, text_col)
    added = discover(items, min_support, min_confidence)
    spans = items.filter("kind != 'token'").select("row", "kind", "s", "e", F.lit(False).alias("new")).unionByName(
        added.withColumn("new", F.lit(True)))
    entry = F.struct("s", "e")
    spans = spans.groupBy("row").agg(
        *(F.array_sort(F.collect_list(F.when(~F.col("new") & (F.col("kind") == k), entry))).alias(k) for k in KINDS),
        F.array_sort(F.collect_list(F.when(F.col("new"), F.struct("s", "e", "kind")))).alias("added"))
    none, none_added = (F.expr(f"CAST(array() AS array<struct<{f}>>)") for f in ("s:int,e:int", "s:int,e:int,kind:string"))
    return rows.join(spans, "row", "left").select(
        "id", "th", *(F.coalesce(k, none).alias(k) for k in KINDS), F.coalesce("added", none_added).alias("added"))


def ordered_spans(with_added: bool) -> Column:
    """Array of (s, k, e, kind) of a row of :func:`find` by start, then kind as in KINDS."""
    parts = [f"transform({k}, b -> named_struct('s', b.s, 'k', {i}, 'e', b.e, 'kind', '{k}'))"
             for i, k in enumerate(KINDS)]
    if with_added:
        order = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
        parts.append(f"transform(added, b -> named_struct('s', b.s, 'k', CAST(array_position({order}, b.kind) - 1 AS int), "
                     "'e', b.e, 'kind', b.kind))")
    return F.expr(f"array_sort(concat({', '.join(parts)}))")


def spans_text(with_added: bool) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(ordered_spans(with_added), lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars",
           **settings) -> DataFrame:
    """``docs`` with every span replaced by its tag, such as [EMAIL]; other texts as they are.

    Where spans overlap, one tag (that of the first) covers them all.
    ``length_col``, if the table has it, becomes the new length of texts that
    change. Texts without an identifier-like character are never shuffled; a
    changed text is cut into stretches, which take their tags on their own and are joined again.
    """
    found = find(docs, id_col, text_col, **settings).select("id", "th", ordered_spans(True).alias("spans"))
    cuts = _cuts(found.filter("size(spans) > 0").dropDuplicates(["id", "th"])).select(
        F.col("id").alias("_pid"), F.col("th").alias("_pth"), F.col("cuts").alias("_cuts"))
    columns = docs.columns
    may = F.coalesce(F.col(text_col).rlike(ANY), F.lit(False))
    rows = docs.filter(may).select(packed_row(columns, "doc"), F.col(id_col).alias("id"),
                                   F.col(text_col).alias("old"), F.xxhash64(text_col).alias("th"))
    rows = rows.join(cuts, F.col("id").eqNullSafe(F.col("_pid")) & (F.col("th") == F.col("_pth")), "left")
    # Within a stretch: what stands before each cut and its tag, then the rest.
    clean = F.expr(f"""array_join(transform(regexp_extract_all(old, '(?s).{{1,{STRETCH}}}', 0), (t, i) ->
        coalesce(transform(array(_cuts[i]), c -> aggregate(c, named_struct('p', 0, 'out', ''),
            (acc, x) -> named_struct('p', x.e, 'out', concat(acc.out, substring(t, acc.p + 1, x.s - acc.p), x.tag)),
            acc -> concat(acc.out, substring(t, acc.p + 1))))[0], t)), '')""")
    changed = F.col("_cuts").isNotNull()
    rows = rows.withColumn("new", F.when(changed, clean).otherwise(F.col("old")))

    def column(name: str) -> Column:
        if name == text_col:
            return F.col("new").alias(name)
        if name == length_col:
            return F.when(changed, F.length("new").cast(docs.schema[name].dataType)).otherwise(
                F.col(f"doc.{quoted(name)}")).alias(name)
        return F.col(f"doc.{quoted(name)}").alias(name)

    return docs.filter(~may).unionByName(rows.select(*map(column, columns)))


def _cuts(found: DataFrame) -> DataFrame:
    """(id, th, cuts): per stretch of a text the cuts (s, e, tag) in it, places counted from its start.

    Spans that overlap are one cut; a cut over a stretch's end goes on in the next without a tag.
    """
    key = ["id", "th"]
    order = Window.partitionBy(*key).orderBy("i")
    spans = found.select(*key, F.posexplode("spans").alias("i", "x")).select(*key, "i", "x.s", "x.e", "x.kind")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("first", F.when(F.col("s") >= F.coalesce(reach, F.lit(0)), 1).otherwise(0))
    spans = spans.withColumn("cut", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    tags = F.create_map(*(F.lit(x) for k in KINDS for x in (k, TAGS[k])))
    cuts = spans.groupBy(*key, "cut").agg(F.min("s").alias("s"), F.max("e").alias("e"),
                                          F.min(F.struct("i", "kind")).alias("f")).withColumn("tag", tags[F.col("f.kind")])
    first = F.floor(F.col("s") / STRETCH).cast("int")
    cuts = cuts.withColumn("k", F.explode(F.sequence(first, F.floor((F.col("e") - 1) / STRETCH).cast("int"))))
    base = F.col("k") * STRETCH
    part = F.struct(F.greatest(F.col("s") - base, F.lit(0)).alias("s"), F.least(F.col("e") - base, F.lit(STRETCH)).alias("e"),
                    F.when(F.col("k") == first, F.col("tag")).otherwise("").alias("tag"))
    return cuts.groupBy(*key, "k").agg(F.array_sort(F.collect_list(part)).alias("parts")).groupBy(*key).agg(
        F.map_from_entries(F.collect_list(F.struct("k", "parts"))).alias("cuts"))
