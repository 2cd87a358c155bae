"""Registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamgauge.llm import langid, lattice, leaks, lines, mixing, near, neighbours, pages, quality, runs, spans, trie, warc
from streamgauge.llm.common import WORD, scratch, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def fold(parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; rows without id count as id ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), fold(3) != 1)
    return quality.score_quality(docs, model).select("doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.verified_pages(spark, path)


ORACLES["op5_warc"] = """
with p as (select page_id, coalesce(encode(html), ''::blob) as payload from pages),
h as (select page_id, octet_length(payload) as n, sha1(payload) as hex, sha256(payload) as key from p),
o as (select key, max(page_id) as owner from h group by key)
select page_id, cast(n as bigint) as payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           cast(((cast('0x' || substr(hex, cast(5*(i//4)+1 as int), 5) as bigint) >> cast(15-5*(i%4) as int)) & 31) as int) + 1, 1)
           for i in range(32)], '') as payload_digest,
       case when page_id = owner then 'response' else 'revisit' end as record_type,
       case when page_id <> owner then owner end as refers_to
from h join o using (key)"""


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.systematic_sample(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


#: One source level decides all targets: the first, in the order of words per weight, that its share doesn't fill.
MIXING_CTES = r"""
sized as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from docs),
totals as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
places as (select *, row_number() over (order by encode(source) nulls last) - 1 as place from totals),
weighted as (select *, [3, 1, 2][place % 3 + 1] as weight from places),
levels as (select *, (1.5::double * sum(source_size) over () - 2 * coalesce(sum(source_size) over (order by source_size / weight, place rows between unbounded preceding and 1 preceding), 0))
                     / sum(weight) over (order by source_size / weight, place rows between current row and unbounded following) as level from weighted),
leveled as (select min_by(level, (source_size / weight, place)) filter (where 2 * source_size >= level * weight) as level from levels),
targets as (select w.source, w.source_size, coalesce(least(cast(2 * w.source_size as double), l.level * w.weight), cast(2 * w.source_size as double)) as target from weighted w, leveled l),
ranked as (select *, row_number() over (partition by source order by size, md5(coalesce(cast(doc_id as varchar), '')), doc_id) as r from sized),
stepped as (select r.*, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
                   (cast('0x' || substr(md5(case when r.source is null then 'n' else 's' || r.source end), 1, 4) as bigint) + 0.5::double) / 65536 as shift
            from ranked r join targets t on r.source is not distinct from t.source),
copied as (select *, cast(floor(shift + rate * r) - floor(shift + rate * (r - 1)) as bigint) as copies from stepped)"""

ORACLES["op10_mixing"] = "with docs as (select * from documents)," + MIXING_CTES + """
select doc_id, cast(size as bigint) as size, source_size, target, cast(copies * size as bigint) as taken from copied"""


@query
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query
def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = spans.remove_repeats(table(spark, sf_dir, "documents"), length=100)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_languages(docs, fold(4) != 2)
    return langid.label_languages(docs, model).select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@query
def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(7) == 2
    scored = lattice.score_texts(table(spark, sf_dir, "documents"), ~held_out, VOCABULARY)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return leaks.leak_report(docs, leaks.find_leaks(docs, table(spark, sf_dir, "benchmark")))


#: The same masks, stretches and share, on tokens instead of their hashes; short items by all their tokens.
LEAK_CTES = r"""
d as (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as t from docs),
b as (select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as t from benchmark),
dp as (select doc_id, t, unnest(range(len(t))) as p from d),
bp as (select item_id, t, unnest(range(len(t))) as p from b where len(t) >= 9),
short as (select item_id, t, 0 as p from b where len(t) between 1 and 8),
masks as (select unnest([[0, 1, 2, 4], [0, 3, 4, 5]]) as m),
lengths as (select distinct len(t) as n from short),
ds as (select doc_id, p, list_transform(m, lambda i: t[p + i + 1]) as seed, cast(m as varchar) as kind from dp, masks where p + m[4] < len(t)
       union all select doc_id, p, t[p + 1 : p + n], cast(n as varchar) from dp, lengths where p + n <= len(t)),
bs as (select item_id, p, list_transform(m, lambda i: t[p + i + 1]) as seed, cast(m as varchar) as kind from bp, masks where p + m[4] < len(t)
       union all select item_id, p, t, cast(len(t) as varchar) from short),
hits as (select distinct doc_id, item_id, ds.p - bs.p as k from ds join bs using (seed, kind)),
eq as (select h.doc_id, h.item_id, h.k, least(20, len(b.t)) as w,
              list_transform(range(greatest(-h.k, 0), least(len(b.t), len(d.t) - h.k)), lambda q: case when d.t[q + h.k + 1] = b.t[q + 1] then 1 else 0 end) as e
       from hits h join d using (doc_id) join b using (item_id)),
best as (select doc_id, item_id, w, list_max(list_transform(range(greatest(len(e) - w + 1, 1)), lambda i: list_sum(e[i + 1 : i + w]))) as matched from eq),
leaked as (select doc_id, count(distinct item_id) as n, min(item_id) as item_id, cast(max(matched) as bigint) as matched
           from best where matched >= w * case when w < 9 then 1 else 0.75 end group by doc_id)"""

ORACLES["op8_decontaminate"] = "with docs as (select * from documents)," + LEAK_CTES + """
select doc_id, n is not null as contaminated, cast(coalesce(n, 0) as bigint) as n_items, item_id, cast(coalesce(matched, 0) as bigint) as matched
from docs left join leaked using (doc_id)"""


@query
def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@query
def op9_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_main_text(table(spark, sf_dir, "pages"))


@query
def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.remove_shared_lines(table(spark, sf_dir, "documents"), least=40, documents=5)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op13_lines"] = r"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
shared as (select key, max(doc_id) as holder from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
marked as (select k.*, s.holder is not null and s.holder <> k.doc_id as gone from k left join shared s on s.key = k.key)
select doc_id, cast(count(*) as bigint) as n_lines, cast(count(*) filter (gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id"""


def with_loops(docs: DataFrame) -> DataFrame:
    """The contract's texts: in one document of ten the words from a place on repeat with a period, both drawn from its id."""
    h = fold(1 << 32)
    words = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))).alias("words"))
    n = F.size("words")
    placed = words.withColumn("first", F.when(n > 0, F.col("g") % n).cast("int"))
    rest = n - F.col("first")
    placed = placed.withColumn("period", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    root = F.slice("words", F.col("first") + 1, F.col("period"))
    loops = F.flatten(F.array_repeat(root, F.ceil(rest / F.col("period")).cast("int")))
    looped = F.slice(F.concat(F.slice("words", F.lit(1), F.col("first")), loops), F.lit(1), n)
    return placed.select("doc_id", F.coalesce(F.array_join(looped, " "), F.col("text")).alias("text"))


@query
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(with_loops(table(spark, sf_dir, "documents")), least=6, times=4)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.short")).alias("period"),
        F.expr("1000 * longest.length div -longest.short").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


@query
def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    turns, convs = trie.grafted(trie.placed_turns(table(spark, sf_dir, "conversations")), conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9)
    return trie.prefix_tree(turns, convs)


#: Every prefix as a list of its turns, and every node below it by comparing lists.
ORACLES["op11_trie"] = r"""
with turns as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
own as (select conv_id, list({'role': role, 'text': text} order by turn nulls first) as seq from turns group by conv_id),
hashed as (select conv_id, seq, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(conv_id as varchar), ''), lambda ch: cast(ascii(ch) as bigint))),
              lambda c, b: list_reduce(list_prepend(xor(c, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 as h from own),
rebuilt as (select c.conv_id, list_concat(coalesce(r.seq[1:c.h], []), c.seq[c.h + 1:]) as seq
            from hashed c left join own r on r.conv_id = c.conv_id - c.conv_id % 5),
steps as (select conv_id, seq, unnest(range(len(seq) + 1)) as d from rebuilt),
paths as (select conv_id, d, seq[1:d] as path, len(seq) = d as ends, case when d = 0 then 0 else strlen(seq[d].text) end as n_bytes from steps),
nodes as (select path, d, min(conv_id) as conv_id, count(*) as n_convs, min(n_bytes) as n_bytes,
                 sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) as ends_sha256 from paths group by path, d),
children as (select path[1:d - 1] as path, d - 1 as d, count(*) as n_children from nodes where d > 0 group by all),
marked as (select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c on c.path = n.path and c.d = n.d),
up as (select path, d, n_children, (n_convs - 1) * n_bytes as saved, unnest(range(d + 1)) as a from marked),
below as (select path[1:a] as path, a as d, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved_tokens from up group by all)
select n.conv_id, cast(n.d as bigint) as depth, p.conv_id as parent_conv_id, cast(n.n_convs as bigint) as n_convs, cast(n.n_children as bigint) as n_children,
       cast(b.n_leaves as bigint) as n_leaves, cast(b.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from marked n join below b on b.path = n.path and b.d = n.d left join nodes p on n.d > 0 and p.d = n.d - 1 and p.path = n.path[1:n.d - 1]"""
