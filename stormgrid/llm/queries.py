"""The registered queries of the corpus operators and the DuckDB twins of those SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from ..session import checkpoint_root
from . import katz, langid, licenses, lines, mixing, quality, repeats, runs, secrets, simhash, warc, whitening, winnowing
from .common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
with d as (select doc_id, regexp_extract_all({_ASCII_LOWER.format('coalesce(text, chr(32))')},
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select item_id, regexp_extract_all({_ASCII_LOWER.format('coalesce(text, chr(32))')},
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
windows as (select item_id, least(len(w), 10) n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') win
            from b, unnest(range(1, greatest(len(w) - 8, 2))) t(i) where len(w) > 0),
lengths as (select distinct n from windows),
spots as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') win
       from d, lengths, unnest(range(1, len(w) - n + 2)) t(i)),
hits as (select doc_id, i, n, item_id from spots join windows using (n, win)),
words as (select doc_id, count(distinct i + k) n_hit from (select distinct doc_id, i, n from hits), unnest(range(n)) t(k)
          group by doc_id),
items as (select doc_id, count(distinct item_id) n_items, array_to_string(list_sort(list(distinct item_id::varchar)), ',') ids
          from hits group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join words using (doc_id) left join items using (doc_id)"""


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("uri"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    path = f"{checkpoint_root(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
    warc.write_archives(warc.with_revisits(pages), path)
    read = warc.stored_pages(warc.reassembled(warc.read_records(spark, path)))
    return read.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                       F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"), "valid")


OP2_SQL = """
with p as (select page_id, coalesce(html, '') html, sha1(coalesce(html, '')) sha, strlen(coalesce(html, '')) n from pages),
last as (select sha, max(page_id) top from p where n >= 1000 group by sha having count(*) > 1)
select page_id, n::bigint payload_bytes, p.sha payload_digest,
       case when top <> page_id then 'revisit' else 'response' end record_type,
       case when top <> page_id then top end refers_to, true as valid
from p left join last on last.sha = p.sha and n >= 1000"""


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.credential_spans(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"].isin("assign", "access", "hex"))

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(table(spark, sf_dir, "documents"))


def _op5_sql() -> str:
    """All windows of all texts against all templates, without any retrieval."""
    rows = ", ".join("('{}', {}, [{}])".format(
        name, licenses.size_class(len(sh)), ", ".join("'" + s + "'" for s in sh))
        for name, text in licenses.TEMPLATES if (sh := licenses.template_shingles(text)))
    return rf"""
with lib(license, c, wanted) as (values {rows}),
d as (select doc_id, regexp_extract_all({_ASCII_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
      from documents),
at_shingle as (select doc_id, i - 1 i, array_to_string(w[i:i + 4], ' ') s from d, unnest(range(1, len(w) - 3)) t(i)),
found as (select distinct doc_id, license, c, len(wanted) m, s, k << c as start
          from at_shingle join (select license, c, wanted, unnest(wanted) s from lib) using (s),
               unnest([i >> c, (i >> c) - 1]) t(k) where k >= 0),
wins as (select doc_id, license, c, start, any_value(m) m, count(*) / any_value(m) share, list(s) hits from found group by all
         having count(*) / any_value(m) >= 0.8),
own as (select * from wins w where not exists (
          select 1 from wins by_ join lib on lib.license = by_.license where by_.doc_id = w.doc_id and by_.share > w.share
          and by_.start < w.start + (2 << w.c) and w.start < by_.start + (2 << by_.c)
          and len(list_filter(w.hits, lambda s: not list_contains(lib.wanted, s))) / w.m < 0.8))
select doc_id, license, max(share) containment, count(distinct start) n_windows, min(start)::bigint first_window
from own group by doc_id, license"""


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP7_SQL = r"""
with d as (select doc_id, string_split(text, chr(10)) l from documents),
w as (select doc_id, i pos, l[i:i + 2] win from d, unnest(range(1, len(l) - 1)) t(i)
      where regexp_matches(array_to_string(l[i:i + 2], chr(10)), '[^\x20\x09-\x0D]')),
ranked as (select doc_id, pos, row_number() over (partition by win order by doc_id, pos) r from w),
gone as (select distinct doc_id, pos + k line from ranked, unnest(range(3)) t(k) where r > 1),
lines as (select doc_id, i line, l[i] txt from d, unnest(range(1, len(l) + 1)) t(i)),
marked as (select doc_id, line, txt, gone.line is not null out from lines left join gone using (doc_id, line)),
runs as (select *, out and not coalesce(lag(out) over (partition by doc_id order by line), false) as begins from marked)
select doc_id, count(*) n_lines, count(*) filter (out) n_removed, count(*) filter (begins) n_runs,
       sha256(coalesce(string_agg(txt, chr(10) order by line) filter (not out), '')) kept_sha256
from runs group by doc_id"""


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out() & F.col("doc_id").isNotNull()))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", F.round("d2", 3).alias("distance"))


def op11_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    return katz.scored(table(spark, sf_dir, "documents"), tenth != 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts of every tenth checksum of an id go on periodically from a word and with a period that the checksum gives."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.expr(
        r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")).alias("w")).withColumn("n", F.size("w"))
    begin = words.where("n > 0").withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("g % n")).withColumn(
        "p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = begin.select("doc_id", F.array_join(F.expr(
        "transform(sequence(0L, n - 1L), i -> w[int(if(i < a, i, a + (i - a) % p))])"), " ").alias("text"))
    return words.where("not coalesce(n > 0, false)").select("doc_id", "text").unionByName(planted)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.expr("""aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>),
        (b, r) -> if(b is null or r.length * b.period > b.length * r.period, r, b))""")
    told = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(told, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _op13_sql(levels: int = 20) -> str:
    """Grams of 16, 32, 64 .. words by doubling dense ranks; a lag at which one stands again next is followed through its text.

    ``levels`` is where the doubling ends: runs with a period above ``2 ** levels`` words are beyond this twin.
    """
    ranks = ["r0 as (select doc_id, i, dense_rank() over (order by word) r from words)"]
    lags = []
    for k in range(levels):
        ranks.append(f"""x{k + 1} as (select doc_id, i, r, lead(r, {1 << k}) over (partition by doc_id order by i) r2 from full{k}),
y{k + 1} as (select doc_id, i, dense_rank() over (order by r, r2) r from x{k + 1} where r is not null and r2 is not null),
r{k + 1} as (select doc_id, i, r from y{k + 1} qualify count(*) over (partition by doc_id, r) > 1)""")
        ranks.append(f"""full{k + 1} as (select doc_id, i, y.r from words left join r{k + 1} y using (doc_id, i)
          where doc_id in (select doc_id from r{k + 1}))""")
        if k + 1 >= 4:
            least = 0 if k + 1 == 4 else 1 << k
            lags.append(f"""select distinct doc_id, q from (select doc_id, lead(i) over (partition by doc_id, r order by i) - i q
          from r{k + 1}) where q > {least} and q <= {2 << k}""")
    ranks.insert(1, "full0 as (select doc_id, i, r from r0)")
    return _OP13_SQL.replace("RANKS", ",\n".join(ranks)).replace("LAGS", " union all ".join(lags))


_OP13_SQL = r"""
with raw as (select doc_id, text, list_reduce(flatten(list_transform(string_split(doc_id::varchar, ''),
                lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0])), lambda c, x: xor(xor(c, x) >> 1,
                case when xor(c, x) & 1 = 1 then 3988292384 else 0 end), 4294967295::bigint) c from documents),
h as (select doc_id, xor(c, 4294967295) h, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') w from raw),
g as (select *, len(w) n, h // 10 g from h),
planted as (select *, case when h % 10 = 0 and n > 0 then g % n end a from g),
period as (select *, 1 + (n - a) // (3 + g % 8) p from planted),
words as (select doc_id, i, case when i >= a then w[1 + a + (i - a) % p] else w[1 + i] end word
          from period, unnest(range(n)) t(i)),
RANKS,
lags as (select distinct doc_id, q from (LAGS)),
same as (select doc_id, q, a.i from lags join words a using (doc_id) join words b using (doc_id)
         where b.i = a.i + q and a.word = b.word),
parts as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) part from same),
stretches as (select doc_id, q, min(i) as start, count(*) + q as length from parts group by doc_id, q, part),
long as (select * from stretches where length >= greatest(24, 3 * q)),
runs as (select * from long r where not exists (select 1 from long s where s.doc_id = r.doc_id and s.q < r.q
         and s.start <= r.start and s.start + s.length >= r.start + r.length)),
top as (select doc_id, start, length, q from runs
        qualify row_number() over (partition by doc_id order by length::decimal(38, 18) / q desc, start, q) = 1),
told as (select doc_id, count(*) n_runs, string_agg(concat(start, ',', length, ',', q, chr(10)), '' order by start, q) t
         from runs group by doc_id),
gone as (select distinct doc_id, i from runs, unnest(range(start + q, start + length)) t(i)),
kept as (select doc_id, string_agg(word, ' ' order by i) t from words anti join gone using (doc_id, i) group by doc_id)
select doc_id, coalesce(n_runs, 0)::bigint n_runs, start::bigint as start, length::bigint as length, q::bigint as period,
       (1000 * length // q)::bigint exponent_milli, sha256(coalesce(told.t, '')) runs_sha256,
       sha256(coalesce(kept.t, '')) collapsed_sha256
from g left join top using (doc_id) left join told using (doc_id) left join kept using (doc_id)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_warc": op2_warc,
    "op3_secrets": op3_secrets,
    "op4_mixing": op4_mixing,
    "op5_licenses": op5_licenses,
    "op6_simhash_groups": op6_simhash_groups,
    "op7_line_dedup": op7_line_dedup,
    "op8_language": op8_language,
    "op9_repeats": op9_repeats,
    "op10_quality": op10_quality,
    "op11_katz": op11_katz,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {"op1_decontamination": OP1_SQL, "op2_warc": OP2_SQL, "op5_licenses": _op5_sql(), "op7_line_dedup": OP7_SQL,
                       "op13_periodic_runs": _op13_sql()}

if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
