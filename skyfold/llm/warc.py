"""Web archives: WARC writing and reading, and the merge of their capture index.

Records are written by Spark's own text writer (a record is a string, the
record separator is the line separator), so archives go to any file system
Spark knows, under its commit protocol. An archive file is one gzip stream;
offsets in the index are those of the uncompressed stream. Records are read
back from the same separator and put together by Content-Length, one record in
memory at a time.

Reading leaves capture runs: the records of one archive part, sorted by URL
key and time. The runs are cut by ranges of the key, and each range's run
slices are merged by a loser tree into the globally ordered capture history.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.common import materialise

SEPARATOR = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ESCAPES = (("%", "%25"), ("\r", "%0D"), ("\n", "%0A"))
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
INDEX = ("page_id long, url string, url_key string, captured string, record_type string, payload_bytes long, "
         "payload_digest string, refers_to long, archive string, offset long, length long")


def base32_of(hex_sha1: Column) -> Column:
    """Upper-case base32 of a SHA-1 given in hexadecimal: 160 bits, 32 letters."""
    letters = []
    for at in range(8):  # five hexadecimal digits are four letters
        word = F.conv(F.substring(hex_sha1, 5 * at + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(word, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def url_key(url: Column) -> Column:
    """Sortable key of a URL: host labels reversed, then port, path and query.

    Scheme, user, a leading www., a default port and the fragment do not
    count; letters are lower-cased. A null URL has the key '' and a text that
    is no URL is its own key.
    """
    low = F.lower(F.regexp_replace(F.trim(url), "#.*$", ""))
    pattern = r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?@]*@)?([^/?:]*)(:[0-9]*)?(.*)$"
    host = F.regexp_replace(F.regexp_extract(low, pattern, 1), r"^www[0-9]*\.", "")
    port = F.regexp_replace(F.regexp_extract(low, pattern, 2), "^:(80|443)?$", "")
    rest = F.regexp_extract(low, pattern, 3)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"),
                   F.when(F.length(rest) == 0, F.lit("/")).otherwise(rest))
    return F.coalesce(F.when(low.rlike(pattern), key).otherwise(low), F.lit(""))


def with_record_types(pages: DataFrame, id_col: str, url_col: str, payload_col: str,
                      min_bytes: int = 0) -> DataFrame:
    """(id, url, payload, payload_bytes, digest, record_type, refers_to) per page.

    Of equal payloads (same SHA-1) of at least ``min_bytes`` bytes the row
    with the smallest id is the response and the others revisit it. A null
    payload is empty. Rows that repeat the smallest id are all responses; if
    no id of a payload is known, its rows are responses too.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                             "sha": F.sha1(F.col("payload").cast("binary"))})
    rows = rows.withColumn("digest", base32_of(F.col("sha"))).drop("sha")
    first = (rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("digest")
             .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1 AND first_id IS NOT NULL").drop("n"))
    again = (F.col("first_id").isNotNull() & (F.col("payload_bytes") >= min_bytes)
             & ~F.col("id").eqNullSafe(F.col("first_id")))
    return rows.join(first, "digest", "left").withColumns({
        "record_type": F.when(again, "revisit").otherwise("response"),
        "refers_to": F.when(again, F.col("first_id"))}).drop("first_id")


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record_id(value: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), value.cast("string"), F.lit(">"))


def _escaped(value: Column) -> Column:
    """A URL with line breaks percent-encoded (and %, so that it can be undone)."""
    for char, code in ESCAPES:
        value = F.replace(value, F.lit(char), F.lit(code))
    return value


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", date_col: str | None = None, min_bytes: int = 0,
                   default_date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one WARC record per row as gzip archives under ``path``.

    Responses carry the payload in UTF-8; revisits carry headers only and name
    the response they refer to. ``date_col`` (text or timestamp) is the capture
    time; where it is missing or null, ``default_date``. Null URLs and ids have
    no header line. Extra columns are ignored.
    """
    rows = pages
    date = F.lit(default_date)
    if date_col:
        kind = pages.schema[date_col].dataType.typeName()
        given = F.col(date_col) if kind == "string" else F.date_format(date_col, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        date = F.coalesce(given, date)
    rows = rows.withColumn("_captured", date)
    # The capture time travels with the URL through the join that finds the copies.
    rows = rows.withColumn("_target", F.struct(F.col(url_col).alias("url"), F.col("_captured").alias("at")))
    rows = with_record_types(rows, id_col, "_target", payload_col, min_bytes)
    revisit = F.col("record_type") == "revisit"
    broken = F.col("url.url").rlike("[\r\n]")
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id(F.col("id"))),
        _line("WARC-Date", F.col("url.at")),
        _line("WARC-Target-URI", F.when(broken, _escaped(F.col("url.url"))).otherwise(F.col("url.url"))),
        _line("X-Target-URI-Escaped", F.when(broken, "true")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to")))),
        _line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"), body)
    rows.select(record.alias("value")).write.option("lineSep", SEPARATOR).option("compression", "gzip").text(path)


def _parse_header(head: str) -> dict[str, str]:
    lines = head.split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}


def _number(value: str | None) -> int | None:
    return None if value is None else int(value.strip("<>").rpartition(":")[2])


def _target(fields: dict[str, str]) -> str | None:
    url = fields.get("warc-target-uri")
    if url is not None and "x-target-uri-escaped" in fields:
        for char, code in reversed(ESCAPES):
            url = url.replace(code, char)
    return url


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records from the separated pieces of archive files, which arrive in file order."""
    sep = SEPARATOR.encode()
    rows: list[tuple] = []
    size, archive, stream, base = 0, None, bytearray(), 0
    for pdf in batches:
        for piece, name in zip(pdf["value"], pdf["archive"]):
            if name != archive:
                if stream.strip(b"\r\n"):
                    raise ValueError(f"{archive}: the last record is cut short")
                archive, stream, base = name, bytearray(), 0
            stream += piece.encode("utf-8") + sep
            while (head := stream.find(sep)) > 0:
                fields = _parse_header(stream[:head].decode("utf-8"))
                end = head + len(sep) + int(fields["content-length"])
                if len(stream) < end + len(sep):
                    break
                if stream[end:end + len(sep)] != sep:
                    raise ValueError(f"{archive}: a record runs past its Content-Length")
                body = bytes(stream[head + len(sep):end])
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                response = fields["warc-type"] == "response"
                if response and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                    raise ValueError(f"{archive}: a payload does not match its digest")
                rows.append((_number(fields.get("warc-record-id")), _target(fields), fields["warc-date"],
                             fields["warc-type"], len(body) if response else int(fields["x-payload-length"]), digest,
                             _number(fields.get("warc-refers-to")), archive, base, end + len(sep),
                             body.decode("utf-8") if response else None))
                size += len(body)
                base += end + len(sep)
                del stream[:end + len(sep)]
            if size > 1 << 23 or len(rows) >= 5000:
                yield _frame(rows)
                rows, size = [], 0
    if stream.strip(b"\r\n"):
        raise ValueError(f"{archive}: the last record is cut short")
    if rows:
        yield _frame(rows)


_RECORD = ["page_id", "url", "captured", "record_type", "payload_bytes", "payload_digest", "refers_to", "archive",
           "offset", "length", "payload"]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_RECORD).astype({"page_id": "Int64", "refers_to": "Int64"})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``.

    Payload digests of responses are verified; a record cut short, run over or
    with a wrong digest fails the read. ``payload`` is null for revisits.
    ``payload_bytes`` and ``payload_digest`` are those of the full payload.
    """
    pieces = (spark.read.option("lineSep", SEPARATOR).text(path)
              .select("value", F.col("_metadata.file_path").alias("archive")))
    return pieces.mapInPandas(
        _records, "page_id long, url string, captured string, record_type string, payload_bytes long, "
                  "payload_digest string, refers_to long, archive string, offset long, length long, payload string")


class LoserTree:
    """K-way merge of sorted sequences: the losers of past matches stay in the tree."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at, self.k = runs, [0] * len(runs), max(1, len(runs))
        self.tree = [-1] * self.k
        for leaf in range(len(runs)):
            self._play(leaf)

    def _before(self, x: int, y: int) -> bool:
        """Whether run x comes before run y; an ended run comes last, ties go to the lower run."""
        if self.at[x] >= len(self.runs[x]):
            return False
        if self.at[y] >= len(self.runs[y]):
            return True
        a, b = self.runs[x][self.at[x]], self.runs[y][self.at[y]]
        return a < b or (a == b and x < y)

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.tree[node] == -1:  # while the tree is built: wait for an opponent
                self.tree[node] = winner
                return
            if self._before(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs:
            top = self.tree[0]
            if self.at[top] >= len(self.runs[top]):
                return
            yield self.runs[top][self.at[top]]
            self.at[top] += 1
            self._play(top)


def _nullable(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns)
    return out.astype({c: "Int64" for c in ("page_id", "refers_to")})


def _merge(columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices: dict[int, list[tuple]] = {}
        for pdf in batches:
            for run_id, part in pdf.groupby("run", sort=False):
                keys = zip(part["url_key"], part["captured"], part["null_id"], part["sort_id"],
                           part["archive"], part["offset"], part[columns].itertuples(index=False, name=None))
                slices.setdefault(run_id, []).extend(keys)
        merged = []
        for row in LoserTree([slices[k] for k in sorted(slices)]):
            merged.append(row[-1])
            if len(merged) >= 10_000:
                yield _nullable(merged, columns)
                merged = []
        if merged:
            yield _nullable(merged, columns)

    return run


def sorted_runs(captures: DataFrame) -> DataFrame:
    """Index rows in locally sorted runs, one per task, with their run number."""
    rows = captures.withColumns({
        "url_key": url_key(F.col("url")), "run": F.spark_partition_id(),
        "null_id": F.col("page_id").isNull().cast("int"), "sort_id": F.coalesce("page_id", F.lit(0))})
    return rows.sortWithinPartitions("url_key", "captured", "null_id", "sort_id", "archive", "offset")


def merge_runs(runs: DataFrame, rows_per_range: int = 20_000) -> DataFrame:
    """Capture history in global order of URL key, time and page id (null last).

    Rows are dealt by ranges of the whole sort key, so a host or URL with many
    captures is spread over ranges; the number of ranges follows the row count.
    A shuffle block keeps the order of the run it was cut from, and each
    range's slices are merged by the loser tree.
    """
    order = ["url_key", "captured", "null_id", "sort_id", "archive", "offset"]
    n = max(1, -(-runs.count() // rows_per_range))
    columns = [f.split()[0] for f in INDEX.split(", ")]
    # The ranges are sorted by run here so that the slices of a range arrive
    # whole whatever order their blocks are fetched in.
    ranged = runs.repartitionByRange(n, *order).sortWithinPartitions("run", *order)
    return ranged.select("run", "null_id", "sort_id", *columns).mapInPandas(_merge(columns), INDEX)


def capture_history(spark: SparkSession, path: str) -> DataFrame:
    """Globally ordered captures of the archives under ``path``, without payloads.

    Columns as INDEX: where each record lies, its URL key, capture time, type,
    the size and digest of the full payload, and the page a revisit refers to.
    """
    captures = read_archives(spark, path).drop("payload")
    return merge_runs(materialise(sorted_runs(captures), "capture_runs"))
