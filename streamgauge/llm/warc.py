"""Content-addressed WARC archive: payload bytes once, exact headers apart, records rebuilt by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamgauge.llm.common import stored

# The base32 alphabet and the WARC/1.1 line end.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in bare upper-case base32: eight groups of 20 bits, four letters each."""
    digest = F.sha1(payload)
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(END))


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


#: A header line of this archive: the target had line breaks, which stand percent-encoded, as does every percent sign.
ESCAPED = "X-Target-Escaped: yes"


def _target(url: Column) -> Column:
    """The target line as it is, or encoded and marked where the url would break the header."""
    breaks = url.rlike("[\\r\\n]")
    encoded = F.replace(F.replace(F.replace(url, F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    marked = F.concat(_line("WARC-Target-URI", encoded), F.lit(ESCAPED + END))
    return F.coalesce(F.when(breaks, marked).otherwise(_line("WARC-Target-URI", url)), F.lit(""))


def write_archive(pages: DataFrame, path: str, least: int = 0) -> None:
    """Store ``pages`` (``page_id``, ``url``, ``html``) under ``path`` in two tables.

    ``payloads`` holds each different payload once, under its SHA-256;
    ``records`` holds each page's exact WARC header under the same key. Of
    pages with equal payloads of at least ``least`` bytes the largest page_id is
    the response and the others revisit it.

    A null html is an empty payload, itself stored once. A null url gives no
    target line; one with line breaks is encoded so that it can be read back and adds no line. Rows without page_id are responses unless a numbered page has
    their payload. Repeated rows of the response are responses again, over the
    one stored payload. An empty table gives two empty tables. Other columns are
    not archived. Equal payloads meet as partial aggregates, so that a third of
    all pages may share one.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    read = pages.select("page_id", "url", payload.alias("payload"))
    stored(
        read.groupBy(F.sha2("payload", 256).alias("key")).agg(F.first("payload").alias("payload"), F.max("page_id").alias("owner")),
        "payloads",
        f"{path}/payloads",
    )
    owners = pages.sparkSession.read.parquet(f"{path}/payloads").select("key", "owner")
    heads = read.select(
        "page_id", "url", F.sha2("payload", 256).alias("key"), F.octet_length("payload").cast("long").alias("n"), base32_sha1(F.col("payload")).alias("digest")
    )
    revisit = (F.col("n") >= least) & F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    header = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _uri(F.col("page_id"))),
        _target(F.col("url")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _uri(F.col("owner"))), _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n")).cast("string")),
        F.lit(END),
    )
    stored(heads.join(owners, "key").select("page_id", "key", revisit.alias("revisits"), header.alias("header")), "records", f"{path}/records")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``key`` and ``payload`` of everything stored; bytes that their SHA-256 doesn't name raise an error."""
    wrong = F.raise_error(F.concat(F.lit("payload differs from its key "), F.col("key"))).cast("binary")
    return spark.read.parquet(f"{path}/payloads").select("key", F.when(F.sha2("payload", 256) == F.col("key"), F.col("payload")).otherwise(wrong).alias("payload"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record's bytes as they would stand in a WARC file: ``page_id``, ``key``, ``record``.

    Responses meet their payload, checked against the digest that addresses it, in a join on that digest; a revisit has none.
    """
    records, payloads = spark.read.parquet(f"{path}/records"), read_payloads(spark, path)
    close = F.lit(END + END).cast("binary")
    full = records.filter(~F.col("revisits")).join(payloads, "key").select("page_id", "key", F.concat(F.col("header").cast("binary"), "payload", close).alias("record"))
    bare = records.filter("revisits").select("page_id", "key", F.concat(F.col("header").cast("binary"), close).alias("record"))
    return full.unionByName(bare)


def parse_records(records: DataFrame) -> DataFrame:
    """The fields of raw records: header lines by name, payload bytes after the blank line.

    Only CR LF ends a line; other characters that may count as line ends are part of a value.
    """
    head = F.substring_index(F.col("record").cast("string"), END + END, 1)
    rows = records.withColumn("_lines", F.split(head, END)).withColumn("_head_bytes", F.octet_length(head))

    def field(name: str) -> Column:
        found = F.get(F.filter("_lines", lambda line: F.startswith(line, F.lit(f"{name}: "))), F.lit(0))
        return F.substring(found, len(name) + 3, 1 << 30)

    target = field("WARC-Target-URI")
    decoded = F.replace(F.replace(F.replace(target, F.lit("%0A"), F.lit("\n")), F.lit("%0D"), F.lit("\r")), F.lit("%25"), F.lit("%"))
    return rows.select(
        *[c for c in records.columns if c != "record"],
        field("WARC-Type").alias("record_type"),
        F.when(F.array_contains("_lines", ESCAPED), decoded).otherwise(target).alias("url"),
        F.regexp_extract(field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("payload_digest"),
        F.nullif(F.regexp_extract(field("WARC-Refers-To"), "^<urn:page:(-?[0-9]+)>$", 1), F.lit("")).cast("long").alias("refers_to"),
        F.col("record").substr(F.col("_head_bytes") + 5, field("Content-Length").cast("int")).alias("payload"),
    )


def verified_pages(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, size and digest of its full payload, its type and what it refers to.

    Sizes and digests come from the payload bytes read back, which are checked against their key, too. A revisit takes them
    from the response that it refers to, over the same key, and a record whose
    header claims another digest than its payload has raises an error.
    """
    parsed = parse_records(read_archive(spark, path))
    bodies = read_payloads(spark, path).select(F.col("key"), F.octet_length("payload").cast("long").alias("n"), base32_sha1(F.col("payload")).alias("digest"))
    own = parsed.filter("record_type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", base32_sha1(F.col("payload")).alias("digest"), "record_type", F.lit(None).cast("long").alias("refers_to")
    )
    other = parsed.filter("record_type = 'revisit'").join(bodies, "key").select("page_id", F.col("n").alias("payload_bytes"), "payload_digest", "digest", "record_type", "refers_to")
    wrong = F.raise_error(F.concat(F.lit("payload digest differs in record "), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))))
    return own.unionByName(other).select(
        "page_id", "payload_bytes", F.when(F.col("digest") == F.col("payload_digest"), F.col("digest")).otherwise(wrong.cast("string")).alias("payload_digest"), "record_type", "refers_to"
    )
