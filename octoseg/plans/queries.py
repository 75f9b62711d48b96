"""Queries of the core operators over the stored tables, each with the same result in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from octoseg import config as C
from octoseg.functions import sequence as Q
from octoseg.functions import stats as T
from octoseg.operators import clustering as K
from octoseg.operators import diagnostics as D
from octoseg.operators import genotypes as G
from octoseg.operators import isolates as I
from octoseg.operators import minhash as M
from octoseg.operators import naming as N
from octoseg.operators import reassortment as R
from octoseg.runtime import Query, scratch, stage, table
from octoseg.sources import exports as E
from octoseg.sources import fasta as F_
from octoseg.sources import store as S

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- shared views, in both languages --------------------------------------------------------------------------------------

#: Letters of the alphabet to bases, so that texts serve as sequences.
ALPHABET, BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"
SEG_LIST = "['PB2','PB1','PA','HA','NP','NA','M','NS']"


def isolates(spark: SparkSession, d: str) -> DataFrame:
    """One row for each isolate: its greatest subtype spelling, JSON and status."""
    s = table(spark, d, "sequences").where("sequence_id is not null")
    return s.groupBy("sequence_id").agg(F.max("subtype").alias("subtype"), F.max("metadata_json").alias("metadata_json"), F.max("status").alias("status"), F.max("collection_date").alias("collection_date"))


ISO = "iso as (select sequence_id, max(subtype) as subtype, max(metadata_json) as metadata_json, max(status) as status, max(collection_date) as collection_date from sequences where sequence_id is not null group by 1)"


def segments(spark: SparkSession, d: str) -> DataFrame:
    """The newest row of each (sequence_id, segment_name, cluster_version); a null version is one, too."""
    s = table(spark, d, "segment_kmers").where("sequence_id is not null and segment_name is not null").distinct()
    return S.latest(s.withColumn("_k", F.struct("created_at", "id")), ["sequence_id", "segment_name", "cluster_version"], "_k").drop("_k")


SEG = "seg as (select * from (select distinct * from segment_kmers where sequence_id is not null and segment_name is not null) qualify row_number() over (partition by sequence_id, segment_name, cluster_version order by created_at desc, id desc) = 1)"


def current(spark: SparkSession, d: str) -> DataFrame:
    """The newest row of each (sequence_id, segment_name) over all versions."""
    s = table(spark, d, "segment_kmers").where("sequence_id is not null and segment_name is not null").distinct()
    return S.latest(s.withColumn("_k", F.struct("created_at", "id")), ["sequence_id", "segment_name"], "_k").drop("_k")


CUR = "cur as (select * from (select distinct * from segment_kmers where sequence_id is not null and segment_name is not null) qualify row_number() over (partition by sequence_id, segment_name order by created_at desc, id desc) = 1)"


def usable(spark: SparkSession, d: str) -> DataFrame:
    """segments() with a usable signature of any parameters: its isolate's subtype, num_hashes, seed and lanes."""
    s = segments(spark, d).where(Q.is_usable("kmer_signature")).join(isolates(spark, d).select("sequence_id", "subtype"), "sequence_id").where("subtype is not null")
    h = Q.signature_header("kmer_signature")
    return s.withColumns({"segment": F.col("segment_name"), "num_hashes": h["num_hashes"], "seed": h["seed"], "lanes": Q.signature_lanes("kmer_signature")})


def records(spark: SparkSession, d: str) -> DataFrame:
    """(subtype, segment, sequence_id, kmer_signature, num_hashes, seed, lanes): the newest usable signature of each
    (sequence_id, segment) over all versions, of any parameters; only those of equal parameters compare."""
    t = table(spark, d, "segment_kmers").where("sequence_id is not null and segment_name is not null").where(Q.is_usable("kmer_signature"))
    # all rows of a record have one signature, so one aggregate takes the place of segments(); signatures are shuffled once, by
    # sequence_id, for it and for the join
    t = t.select("sequence_id", "segment_name", "kmer_signature", "created_at", "id").repartition("sequence_id")
    s = t.groupBy("sequence_id", F.col("segment_name").alias("segment")).agg(F.max_by("kmer_signature", F.struct("created_at", "id")).alias("kmer_signature"))
    s = s.join(isolates(spark, d).select("sequence_id", "subtype"), "sequence_id").where("subtype is not null")
    h = Q.signature_header("kmer_signature")
    return s.select("subtype", "segment", "sequence_id", "kmer_signature", h["num_hashes"].alias("num_hashes"), h["seed"].alias("seed"), Q.signature_lanes("kmer_signature").alias("lanes"))


def word_sql(a: int, h: str = "h") -> str:
    """SQL for the little-endian word that begins at a place of hexadecimal digits."""
    return f"('0x' || {h}[{a}+6:{a}+7] || {h}[{a}+4:{a}+5] || {h}[{a}+2:{a}+3] || {h}[{a}:{a}+1])::bigint"


def usable_sql(source: str, signature: str = "kmer_signature") -> str:
    """SQL for the rows of a source with a usable signature: h (hexadecimal), n lanes, seed."""
    return f"select *, {word_sql(9)} as seed from (select *, (octet_length({signature}) - 16) // 8 as n, hex({signature}) as h from {source} where octet_length({signature}) >= 24) where octet_length({signature}) = 16 + 8 * {word_sql(1)} and {word_sql(25)} > 0"


USABLE = f"us as (select i.subtype, s.segment_name as segment, s.* from ({usable_sql('seg')}) s join iso i using (sequence_id) where i.subtype is not null)"
REC = f"{USABLE}, rec as (select * from us qualify row_number() over (partition by sequence_id, segment order by created_at desc, id desc) = 1)"
WITH = f"with {ISO}, {SEG}, {REC}"


def equal_sql(a: str, b: str) -> str:
    """SQL for the number of equal lanes of two rows with h and n."""
    return f"list_sum(list_transform(range({a}.n), lambda i: ({a}.h[33+16*i:48+16*i] = {b}.h[33+16*i:48+16*i])::int))"


#: SQL for whether two rows compare.
LIKE_SQL = "a.n = b.n and a.seed = b.seed"


def latest_genotypes(spark: SparkSession, d: str) -> DataFrame:
    """The newest row of each isolate with a filled genotype profile."""
    g = table(spark, d, "genotypes").where("sequence_id is not null and trim(coalesce(genotype_profile, '')) <> ''")
    return S.latest(g.withColumn("_k", F.struct("created_at", "id")), ["sequence_id"], "_k").drop("_k")


GENO = "geno as (select * from genotypes where sequence_id is not null and trim(coalesce(genotype_profile, '')) <> '' qualify row_number() over (partition by sequence_id order by created_at desc, id desc) = 1)"
LONG = f"""{GENO}, long as (
  select sequence_id, (ord - 1)::int as ord, {SEG_LIST}[ord] as segment, case when shown = '?' then 'ORPHAN' when shown in ('-', '') then 'MISSING' else 'ASSIGNED' end as status,
         case when shown not in ('?', '-', '') then shown end as cluster_id
  from (select sequence_id, unnest(string_split(upper(regexp_replace(genotype_profile, '\\s+', '', 'g')), '.')[1:8]) as shown,
               generate_subscripts(string_split(upper(regexp_replace(genotype_profile, '\\s+', '', 'g')), '.')[1:8], 1) as ord from geno))"""


def long_profiles(spark: SparkSession, d: str) -> DataFrame:
    return G.parse_profiles(latest_genotypes(spark, d))


def assignments(spark: SparkSession, d: str) -> DataFrame:
    """Current cluster assignments: a cluster or an orphan."""
    c = F.nullif(F.trim("cluster_id"), F.lit(""))
    return current(spark, d).select("sequence_id", F.col("segment_name").alias("segment"), c.alias("cluster_id"), (c.isNull() | (F.coalesce("is_orphan", F.lit(0)) == 1)).alias("is_orphan"))


# --- headers and sequences --------------------------------------------------------------------------------------------------


def headers(spark: SparkSession, d: str) -> DataFrame:
    """A header for each current segment: id, segment, subtype and date between bars, or with a segment number."""
    s = current(spark, d).join(isolates(spark, d), "sequence_id")
    bar = F.concat_ws("|", "sequence_id", "segment_name", "subtype", "collection_date")
    num = F.concat(F.lit("x_segment_"), G.ordinal("segment_name") + 1, F.lit("_"), F.concat_ws("_", "subtype", "sequence_id"))
    seq = F.repeat(F.translate(F.md5(F.concat("sequence_id", "segment_name")), "0123456789abcdef", "ACGTNACGTRACGTAC"), 30)
    return s.select(F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, num).otherwise(bar).alias("header"), seq.alias("seq"))


HEAD = f"""with {ISO}, {CUR}, head as (select id as pos, case when id % 3 = 0 then 'x_segment_' || list_position({SEG_LIST}, segment_name) || '_' || concat_ws('_', subtype, sequence_id)
  else concat_ws('|', sequence_id, segment_name, subtype, collection_date) end as header,
  repeat(translate(md5(sequence_id || segment_name), '0123456789abcdef', 'ACGTNACGTRACGTAC'), 30) as seq from cur join iso using (sequence_id))"""
_SEGMENT_SQL = "case " + " ".join(f"when regexp_matches(header, '(?i){p}') then '{s}'" for s, p in C.SEGMENT_PATTERNS.items()) + f" else {SEG_LIST}[try_cast(nullif(regexp_extract(header, '(?i)segment[_\\s]*(\\d)', 1), '') as int)] end"
_ID_SQL = "header"
for _s in C.SEGMENTS:
    _ID_SQL = f"regexp_replace(regexp_replace({_ID_SQL}, '(?i)\\|{_s}\\b', '', 'g'), '(?i)_{_s}\\b', '', 'g')"
_ID_SQL = f"regexp_replace(string_split(regexp_replace(regexp_replace({_ID_SQL}, '(?i)\\|segment[_\\s]*\\d', '', 'g'), '(?i)_segment[_\\s]*\\d', '', 'g'), '|')[1], '^\\s+|\\s+$', '', 'g')"
_ID_SQL = f"case when {_ID_SQL} = '' then 'unknown_' || md5(header)[1:8] else {_ID_SQL} end"
_SUB_SQL = "case when contains(upper(header), 'H1N1PDM') then 'H1N1pdm09' when contains(upper(header), 'H3N2') then 'H3N2' when contains(upper(header), 'H1N1') then 'H1N1pdm09' end"
_DATE_SQL = "coalesce(nullif(regexp_extract(header, '(\\d{4}-\\d{2}-\\d{2})', 1), ''), replace(nullif(regexp_extract(header, '(\\d{4}/\\d{2}/\\d{2})', 1), ''), '/', '-'))"


@query(f"{HEAD} select pos, {_SEGMENT_SQL} as segment, {_SUB_SQL} as subtype, {_DATE_SQL} as collection_date, {_ID_SQL} as sequence_id from head")
def header_fields(spark: SparkSession, d: str) -> DataFrame:
    return headers(spark, d).select("pos", Q.identify_segment("header").alias("segment"), Q.identify_subtype("header").alias("subtype"), Q.extract_collection_date("header").alias("collection_date"), Q.isolate_id("header").alias("sequence_id"))


_PROC = f"{HEAD}, rec as (select pos, header, seq, {_SEGMENT_SQL} as segment, coalesce({_SUB_SQL}, 'H3N2') as subtype, {_DATE_SQL} as collection_date, {_ID_SQL} as sequence_id from head), iso2 as (select sequence_id, arg_min(subtype, pos) as subtype, first(collection_date order by pos) as collection_date, count(distinct segment)::int as segments_found from rec where segment is not null group by 1)"


@query(f"{_PROC}, sh as (select sequence_id, string_agg(header, chr(10) order by pos, header) as source_headers from rec where segment is not null group by 1) select iso2.*, segments_found / 8.0::double as completeness, segments_found = 8 as is_complete, source_headers from iso2 join sh using (sequence_id)")
def process_isolates(spark: SparkSession, d: str) -> DataFrame:
    return I.process_records(headers(spark, d))[0].withColumn("source_headers", F.array_join("source_headers", "\n"))


@query(f"{_PROC}, s2 as (select * from rec where segment is not null qualify row_number() over (partition by sequence_id, segment order by pos) = 1) select s2.sequence_id, s2.segment, iso2.subtype, length(seq)::int as length, length(regexp_replace(seq, '[^NRYSWKMBDHV]', '', 'g')) / length(seq) <= 0.2 as is_valid from s2 join iso2 using (sequence_id)")
def process_segments(spark: SparkSession, d: str) -> DataFrame:
    return I.process_records(headers(spark, d))[1].select("sequence_id", "segment", "subtype", "length", "is_valid")


@query(f"""{_PROC} select 'total' as kind, unnest(['total_isolates', 'complete_genomes', 'partial_genomes']) as name, unnest([count(*), count(*) filter (segments_found = 8), count(*) filter (segments_found <> 8)]) as n from iso2
union all select 'subtype', subtype, count(*) from iso2 group by 2
union all select 'segment', s, (select count(distinct sequence_id) from rec where segment = s) from (select unnest({SEG_LIST}) as s)""")
def processing_summary(spark: SparkSession, d: str) -> DataFrame:
    return I.processing_summary(*I.process_records(headers(spark, d)))


def raw_sequences(spark: SparkSession, d: str) -> DataFrame:
    """(pos, segment, raw): letters of either case, U, blanks, ambiguous and wrong ones, of lengths from 32 to 3,840."""
    c = current(spark, d)
    digest = F.md5(F.concat("sequence_id", "segment_name"))
    alphabet = F.element_at(F.array(*map(F.lit, RAW)), (F.col("id") % len(RAW) + 1).cast("int"))
    letter = F.transform(F.split(digest, ""), lambda x: F.substring(alphabet, F.instr(F.lit("0123456789abcdef"), x), F.lit(1)))
    return c.select(F.col("id").alias("pos"), F.col("segment_name").alias("segment"), F.repeat(F.array_join(letter, ""), (F.col("id") % 120 + 1).cast("int")).alias("raw"))


#: Alphabets of raw_sequences(): clean ones, ambiguous ones, and one with a wrong letter.
RAW = ["ACGTacguACGT\tU A", "ACGTACGTACGTACGT", "ACGTNacgtRACGTAC", "NNNRYSWKMBDHVnAC", "ACGTACGTXACGTzAC"]
_LETTERS = "(['" + "','".join(RAW) + f"'])[id % {len(RAW)} + 1]"
RAW_SQL = f"raw as (select id as pos, segment_name as segment, repeat(translate(md5(sequence_id || segment_name), '0123456789abcdef', {_LETTERS}), (id % 120 + 1)::int) as raw from cur)"
_CLEAN_SQL = "replace(upper(regexp_replace(raw, '\\s', '', 'g')), 'U', 'T')"
_RANGE_SQL = "case segment " + " ".join(f"when '{r[0]}' then {{{{'l': {r[4]}, 'h': {r[5]}}}}}" for r in C.TABLE) + " end"
_RANGE_SQL = _RANGE_SQL.replace("{{", "{").replace("}}", "}")


@query(f"""with {CUR}, {RAW_SQL}, c as (select pos, segment, {_CLEAN_SQL} as seq from raw), t as (select *, length(seq) as n, {_RANGE_SQL} as r,
  length(regexp_replace(seq, '[^NRYSWKMBDHV]', '', 'g')) / length(seq) as amb, regexp_replace(seq, '[ACGTUNRYSWKMBDHV]', '', 'g') as bad from c),
f as (select *, n || ' bp, expected ' || r.l || '-' || r.h || ')' as span from t)
select pos, md5(seq) as digest, n::int as length, bad = '' and amb <= 0.2 as is_valid, array_to_string(list_filter([
  case when bad <> '' then 'Invalid characters: ' || array_to_string(list_sort(list_distinct(string_split(bad, ''))), '') end,
  case when n < r.l * 0.5 then 'Very short (' || span when n < r.l then 'Below range (' || span when n > r.h * 1.1 then 'Above range (' || span end,
  case when amb > 0.05 then 'High ambiguity: ' || printf('%.1f', amb * 100) || '%' end, case when amb > 0.2 then 'Excessive ambiguity' end], lambda x: x is not null), '; ') as notes from f""")
def sequence_validation(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with each raw sequence once it is cleaned."""
    t = raw_sequences(spark, d).select("pos", "segment", Q.clean_sequence("raw").alias("seq"))
    return t.select("pos", F.md5("seq").alias("digest"), F.length("seq").alias("length"), Q.is_valid_sequence("seq").alias("is_valid"), F.array_join(Q.sequence_notes("seq", F.col("segment")), "; ").alias("notes"))


_FASTA = f"""{HEAD}, rec as (select pos, header, seq, {_ID_SQL} as sequence_id from head), parts as (select *, row_number() over (partition by sequence_id order by pos) - 1 as place from rec)"""
_TRIMMED = "regexp_replace(header, '^\\s+|\\s+$', '', 'g')"


def fasta_texts(spark: SparkSession, d: str) -> DataFrame:
    """(sequence_id, text): each isolate's records as one text: blanks before and after some headers, lines of 100 letters
    that end in one or two characters, and an empty line."""
    h = headers(spark, d).withColumn("sequence_id", Q.isolate_id("header"))
    begin = F.when(F.col("pos") % 2 == 0, F.lit(">")).otherwise(F.lit("  > "))
    record = F.concat(begin, "header", F.lit(" \n"), F.regexp_replace("seq", "(.{100})", "$1\r\n"), F.lit("\n\n"))
    return h.groupBy("sequence_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", record.alias("r")))), lambda x: x["r"]), "").alias("text"))


@query(f"{_FASTA} select sequence_id, place::int as pos, {_TRIMMED} as header, seq from parts")
def fasta_strings(spark: SparkSession, d: str) -> DataFrame:
    """The records of each isolate's text."""
    t = fasta_texts(spark, d).withColumn("text", F.concat(F.lit("; something before the first header\n"), "text"))
    return F_.parse_fasta_string(t, "text", "sequence_id")


@query(f"{HEAD} select {_TRIMMED} as header, md5(seq) as digest, count(*) as n from head group by 1, 2")
def fasta_files(spark: SparkSession, d: str) -> DataFrame:
    """The records of files that hold all texts."""
    path = scratch(spark, "fasta")
    fasta_texts(spark, d).select("text").write.text(path)
    return F_.parse_fasta(spark, path).groupBy("header", F.md5("seq").alias("digest")).agg(F.count("*").alias("n"))


@query(f"""{HEAD}, rec as (select pos, header, seq, {_SEGMENT_SQL} as segment, coalesce({_SUB_SQL}, 'H3N2') as subtype, {_ID_SQL} as sequence_id from head)
select sequence_id, arg_min(subtype, pos) as subtype, count(distinct segment)::int as segments_found from rec where segment is not null group by 1""")
def fasta_isolates(spark: SparkSession, d: str) -> DataFrame:
    """Isolates from the texts, read and processed in one go."""
    return I.process_string(fasta_texts(spark, d), "text", "sequence_id")[0].select("sequence_id", "subtype", "segments_found")


# --- k-mers ------------------------------------------------------------------------------------------------------------------


def dna(spark: SparkSession, d: str) -> DataFrame:
    t = F.translate(F.regexp_replace(F.translate("text", ALPHABET.upper(), ALPHABET), "[^a-z]", ""), ALPHABET, BASES)
    return table(spark, d, "documents").select("doc_id", t.alias("dna"))


DNA = f"dna as (select doc_id, translate(regexp_replace(translate(text, '{ALPHABET.upper()}', '{ALPHABET}'), '[^a-z]', '', 'g'), '{ALPHABET}', '{BASES}') as dna from documents)"
_CANON = "least(k, reverse(translate(k, 'ACGT', 'TGCA')))"


@query(f"with {DNA}, km as (select doc_id, {_CANON} as k from (select doc_id, substr(dna, i, 21) as k from (select doc_id, dna, unnest(range(1, length(dna) - 19)) as i from dna))) select d.doc_id, count(k.k) as total, count(distinct k.k) as distinct_kmers from dna d left join km k using (doc_id) where d.dna is not null group by 1")
def kmer_set_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.kmer_counts(dna(spark, d).where("dna is not null"), ["doc_id"], "dna", [21]).drop("k")


@query(f"with {DNA}, km as (select {_CANON} as kmer from (select substr(dna, i, 21) as k from (select dna, unnest(range(1, length(dna) - 19)) as i from dna))), n as (select kmer, count(*) as n from km group by 1) select n as occurrences, count(*) as kmers, min(kmer) as first_kmer from n group by 1")
def kmer_frequencies(spark: SparkSession, d: str) -> DataFrame:
    """How many k-mers occur once, twice, and so on over all texts."""
    f = M.kmer_frequencies(dna(spark, d), [], "dna", 21)
    return f.groupBy(F.col("n").alias("occurrences")).agg(F.count("*").alias("kmers"), F.min("kmer").alias("first_kmer"))


@query(f"""with {DNA}, ks as (select doc_id, dna, unnest([15, 17, 19, 21, 23, 25, 27, 29, 31]) as kk from dna where dna is not null),
km as (select doc_id, kk, {_CANON} as k from (select doc_id, kk, substr(dna, i, kk) as k from (select doc_id, dna, kk, unnest(range(1, length(dna) - kk + 2)) as i from ks))),
c as (select ks.doc_id, ks.kk, count(km.k) as t, count(distinct km.k) as u from ks left join km on ks.doc_id = km.doc_id and ks.kk = km.kk group by 1, 2)
select kk as k, round(avg(u), 8) as mean_unique, round(stddev_pop(u), 8) as std_unique, round(avg(t), 8) as mean_total, round(avg(case when t > 0 then u / t else 0 end), 8) as mean_ratio from c group by 1""")
def kmer_sweep(spark: SparkSession, d: str) -> DataFrame:
    s = M.parameter_sweep(dna(spark, d).where("dna is not null"), "dna")
    return s.select("k", *(F.round(c, 8).alias(c) for c in s.columns if c != "k"))


_IUPAC = "ABCDGHKMNRSTVWYU"
_PAIRED = "".join(C.complements()[x] for x in _IUPAC)


@query(f"with {CUR} select id as pos, reverse(translate(translate(md5(sequence_id || segment_name), '0123456789abcdef', '{_IUPAC}'), '{_IUPAC}', 'TVGHCDMKNYSABWRA')) as back from cur")
def reverse_complements(spark: SparkSession, d: str) -> DataFrame:
    """Reverse complements over the whole IUPAC alphabet."""
    return current(spark, d).select(F.col("id").alias("pos"), Q.reverse_complement(F.translate(F.md5(F.concat("sequence_id", "segment_name")), "0123456789abcdef", _IUPAC)).alias("back"))


@query(f"""{HEAD}, w as (select pos, substr(seq, i, 15) as k from (select pos, seq, unnest(range(1, 947)) as i from (select pos, translate(seq, 'RY', 'AC') as seq from head)))
select pos, count(*) as total, count(distinct c) as distinct_kmers, min(c) as first_kmer from (select pos, least(k, reverse(translate(k, 'ACGT', 'TGCA'))) as c from w where not contains(k, 'N')) group by 1""")
def kmers_without_n(spark: SparkSession, d: str) -> DataFrame:
    """k-mers of sequences with gaps: windows with an N are left out."""
    k = headers(spark, d).select("pos", F.explode(Q.kmers(F.translate("seq", "RY", "AC"), 15)).alias("k"))
    return k.groupBy("pos").agg(F.count("*").alias("total"), F.countDistinct("k").alias("distinct_kmers"), F.min("k").alias("first_kmer"))


# --- signatures -----------------------------------------------------------------------------------------------------------------


@query(f"""select id, {word_sql(1)} as num_hashes, {word_sql(9)} as seed, {word_sql(17)} as kmer_count, {word_sql(25)} as unique_kmer_count,
(n = 16 + 8 * {word_sql(1)} and {word_sql(25)} > 0 and {word_sql(1)} > 0) as usable from (select distinct id, hex(kmer_signature) as h, octet_length(kmer_signature) as n from segment_kmers) where n >= 16""")
def signature_parts(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "segment_kmers").select("id", "kmer_signature").distinct().where(F.length("kmer_signature") >= 16)
    h = Q.signature_header("kmer_signature")
    return s.select("id", h["num_hashes"].alias("num_hashes"), h["seed"].alias("seed"), h["kmer_count"].alias("kmer_count"), h["unique_kmer_count"].alias("unique_kmer_count"), Q.is_usable("kmer_signature").alias("usable"))


@query(f"""{WITH} select segment, n as num_hashes, seed, lane, min(('0x' || h[c+14:c+15] || h[c+12:c+13] || h[c+10:c+11] || h[c+8:c+9] || h[c+6:c+7] || h[c+4:c+5] || h[c+2:c+3] || h[c:c+1])::ubigint)::varchar as value
from (select segment, n, seed, h, unnest(range(n))::int as lane from rec) cross join lateral (select 33 + 16 * lane as c) group by 1, 2, 3, 4""")
def signature_union(spark: SparkSession, d: str) -> DataFrame:
    """The signature of the union of each segment's sequences of equal parameters, lane by lane."""
    m = M.merge_signatures(records(spark, d), ["segment", "num_hashes", "seed"])
    return m.select("segment", "num_hashes", "seed", "lane", F.col("value").cast("string").alias("value"))


def _murmur_sql() -> str:
    """SQL for MurmurHash3 x64 128 of k-mers of 17 to 31 letters, seed 42: one block of 16 bytes and a tail.

    Columns of the steps: h1, h2. Products are taken in 128 bits and cut to 64.
    """
    mask, c1, c2 = "18446744073709551615::uhugeint", "9782798678568883157::uhugeint", "5545529020109919103::uhugeint"
    mul = lambda x, y: f"(({x}) * ({y}) & {mask})"
    add = lambda x, y: f"((({x}) + ({y})) & {mask})"
    rot = lambda x, r: f"(((({x}) << {r}) | (({x}) >> {64 - r})) & {mask})"
    byte = lambda i: f"(ascii(substr(k || repeat(chr(1), 32), {i + 1}, 1))::uhugeint * (case when {i} < length(k) then 1 else 0 end)::uhugeint)"
    word = lambda a: " + ".join(f"({byte(a + i)} << {8 * i})" for i in range(8))
    mix = lambda x: f"xor({x}, ({x}) >> 33)"
    q = f"select *, {word(0)} as w0, {word(8)} as w1, {word(16)} as w2, {word(24)} as w3 from {{source}}"
    q = f"select *, xor(42::uhugeint, {mul(rot(mul('w0', c1), 31), c2)}) as a from ({q})"
    q = f"select *, {add(mul(add(rot('a', 27), '42'), '5::uhugeint'), '1390208809::uhugeint')} as a1, xor(42::uhugeint, {mul(rot(mul('w1', c2), 33), c1)}) as b from ({q})"
    q = f"select *, {add(mul(add(rot('b', 31), 'a1'), '5::uhugeint'), '944331445::uhugeint')} as b1 from ({q})"
    q = f"select *, case when length(k) > 24 then xor(b1, {mul(rot(mul('w3', c2), 33), c1)}) else b1 end as b2, case when length(k) > 16 then xor(a1, {mul(rot(mul('w2', c1), 31), c2)}) else a1 end as a2 from ({q})"
    q = f"select *, xor(a2, length(k)::uhugeint) as a3, xor(b2, length(k)::uhugeint) as b3 from ({q})"
    q = f"select *, {add('a3', 'b3')} as a4 from ({q})"
    q = f"select *, {add('b3', 'a4')} as b4 from ({q})"
    for x, y in (("a4", "a5"), ("b4", "b5")):
        q = f"select *, {mul(mix(x), '18397679294719823053::uhugeint')} as {y}m from ({q})"
        q = f"select *, {mul(mix(y + 'm'), '14181476777654086739::uhugeint')} as {y}n from ({q})"
        q = f"select *, {mix(y + 'n')} as {y} from ({q})"
    q = f"select *, {add('a5', 'b5')} as h1 from ({q})"
    return f"select *, {add('b5', 'h1')} as h2 from ({q})"


_K_SQL = "case segment " + " ".join(f"when '{r[0]}' then {r[1]}" for r in C.TABLE) + " end"


@query(f"""with {DNA}, s as (select doc_id, segment, dna, {_K_SQL} as kk from (select doc_id, dna, {SEG_LIST}[doc_id % 8 + 1] as segment from dna where dna is not null)),
km as (select distinct doc_id, {_CANON} as k from (select doc_id, substr(dna, i, kk) as k from (select doc_id, dna, kk, unnest(range(1, length(dna) - kk + 2)) as i from s))),
u as (select k from km group by 1), hashed as materialized (select k, h1, h2 from ({_murmur_sql().replace('{source}', 'u')})),
lane as (select doc_id, l, min((h1 + l::uhugeint * h2) & 18446744073709551615::uhugeint) as v from km join hashed using (k) cross join unnest(range(8)) as t(l) group by 1, 2),
sig as (select doc_id, string_agg(v::varchar, ',' order by l) as lanes from lane group by 1), n as (select doc_id, count(*) as u from km group by 1)
select s.doc_id, s.segment, s.kk::int as k_value, greatest(0, length(dna) - kk + 1) as kmer_count, coalesce(u, 0) as unique_kmer_count, coalesce(lanes, '{','.join(['18446744073709551615'] * 8)}') as lanes from s left join sig using (doc_id) left join n using (doc_id)""")
def build_signatures(spark: SparkSession, d: str) -> DataFrame:
    """Signatures of 8 lanes of all texts as sequences of the eight segments, with each segment's k."""
    s = dna(spark, d).where("dna is not null").select("doc_id", F.get(F.array(*map(F.lit, C.SEGMENTS)), (F.col("doc_id") % 8).cast("int")).alias("segment"), F.col("dna").alias("seq"))
    b = M.build_signatures(s, C.Sketch(lanes=8))
    h = Q.signature_header("kmer_signature")
    value = lambda x: F.conv(F.concat(*(F.substring(x, 2 * i + 1, 2) for i in range(7, -1, -1))), 16, 10)
    return b.select("doc_id", "segment", "k_value", h["kmer_count"].alias("kmer_count"), h["unique_kmer_count"].alias("unique_kmer_count"), F.array_join(F.transform(Q.signature_lanes("kmer_signature"), value), ",").alias("lanes"))


@query("select * from (values ('ACGTACGTACGTACGTACGTA', 42, '13036166743686632327', '4543100632486228299')) as t(kmer, seed, h1, h2)")
def hash_selftest(spark: SparkSession, d: str) -> DataFrame:
    """The hash of the fixed k-mer, made on an executor; its words are published constants."""

    def run(batches):
        for pdf in batches:
            M.selftest()
            words = [M.murmur3_x64_128(np.frombuffer(k.encode(), np.uint8)[None, :], n) for k, n in zip(pdf["kmer"], pdf["seed"])]
            yield pdf.assign(h1=[str(int(a[0])) for a, _ in words], h2=[str(int(b[0])) for _, b in words])

    return spark.createDataFrame([(M.GOLDEN[0].decode(), M.GOLDEN[1])], "kmer string, seed int").mapInPandas(run, "kmer string, seed int, h1 string, h2 string")


@query(f"""{WITH}, cls as (select subtype, segment, n, seed, h[33:] as lanes, any_value(h) as h, min(sequence_id) as rep, count(*) as copies from rec group by 1, 2, 3, 4, 5),
cell as (select subtype, segment, n, seed, rep, copies, i, h[33+16*i:48+16*i] as v from cls cross join unnest(range(n)) as u(i)),
eqc as (select a.subtype, a.segment, a.n, a.rep as a, b.rep as b, any_value(a.copies) as copies_a, any_value(b.copies) as copies_b, count(*) as m from cell a join cell b on a.subtype = b.subtype and a.segment = b.segment and {LIKE_SQL} and a.i = b.i and a.v = b.v and a.rep < b.rep group by 1, 2, 3, 4, 5)
select subtype, segment, a, b, copies_a, copies_b, round(1 - m / n, 6) as dist from eqc where m >= 0.9 * n
union all select subtype, segment, rep, rep, copies, copies, 0.0 from cls where copies > 1""")
def similar_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of different signatures of a subtype, segment and parameters with an agreement of 0.9 or more, each by its
    first record and with the number of its copies; copies among themselves are one row with their first record twice."""
    g = ["subtype", "segment", "num_hashes", "seed"]
    r = records(spark, d)
    c = stage(r.groupBy(*g, "lanes").agg(F.min("sequence_id").alias("sequence_id"), F.count("*").alias("copies")).withColumn("threshold", F.lit(0.9)), "classes")
    e = K.similarity_edges(c, g, "threshold", copies=False)
    size = c.select(*g, "sequence_id", "copies")
    out = e.join(size.toDF(*g, "a", "copies_a"), [*g, "a"]).join(size.toDF(*g, "b", "copies_b"), [*g, "b"])
    own = size.where("copies > 1").select(*g, F.col("sequence_id").alias("a"), F.col("sequence_id").alias("b"), F.col("copies").alias("copies_a"), F.col("copies").alias("copies_b"), F.lit(0.0).alias("dist"))
    cols = ["subtype", "segment", "a", "b", "copies_a", "copies_b", F.round("dist", 6).alias("dist")]
    return out.select(*cols).union(own.select(*cols))


# --- clusters -------------------------------------------------------------------------------------------------------------------


def reference(spark: SparkSession, d: str) -> DataFrame:
    """Active clusters with a usable centroid: (subtype, segment, cluster_id, num_hashes, seed, centroid)."""
    c = table(spark, d, "clusters").where("is_active = 1 and segment_name is not null and subtype is not null").where(Q.is_usable("centroid_signature"))
    h = Q.signature_header("centroid_signature")
    return c.select("subtype", F.col("segment_name").alias("segment"), F.concat_ws("/", "version", "cluster_id").alias("cluster_id"), h["num_hashes"].alias("num_hashes"), h["seed"].alias("seed"), Q.signature_lanes("centroid_signature").alias("centroid")).distinct()


REF = f"ref as (select distinct subtype, segment_name as segment, concat_ws('/', version, cluster_id) as cluster_id, h, n, seed from ({usable_sql('clusters', 'centroid_signature')}) where is_active = 1 and segment_name is not null and subtype is not null)"
#: Sketches of 64 lanes lie about 0.7 from their centroid, so the stored clusters are matched at 0.6.
LOOSE = C.Grouping(same={x: 0.6 for x in C.SEGMENTS})
_THRESHOLD_SQL = "0.6 + case subtype when 'H3N2' then -0.02 else 0 end"


_NEAREST = f"""{WITH}, {REF}, near as (select a.subtype, a.segment, a.sequence_id, 1 - {equal_sql('a', 'b')} / a.n as d, b.cluster_id from rec a join ref b on a.subtype = b.subtype and a.segment = b.segment and {LIKE_SQL}),
best as (select * from near qualify row_number() over (partition by subtype, segment, sequence_id order by d, cluster_id) = 1),
j as (select r.subtype, r.segment, r.sequence_id, d, b.cluster_id as n, coalesce(d <= 1 - ({_THRESHOLD_SQL}) + 1e-12, false) as inside from rec r left join best b using (subtype, segment, sequence_id))"""


@query(f"""{_NEAREST} select subtype, segment, sequence_id, case when inside then n end as cluster_id, round(coalesce(d, 1.0), 6) as distance, not inside as is_orphan, case when not inside then n end as nearest_cluster from j""")
def assign_to_existing(spark: SparkSession, d: str) -> DataFrame:
    return K.assign_to_existing(records(spark, d), reference(spark, d), LOOSE).withColumn("distance", F.round("distance", 6))


#: Classes of equal signatures with their copies, the numbers of equal lanes of classes that have any, and the components
#: of those within the threshold of each other: only within one can anything merge.
_T_SQL = "case segment " + " ".join(f"when '{r[0]}' then {r[2]}" for r in C.TABLE) + " end + case subtype when 'H3N2' then -0.02 else 0 end"
_CLASSES = f"""{WITH.replace('with ', 'with recursive ', 1)}, cls as (select subtype, segment, n, seed, h[33:] as lanes, any_value(h) as h, min(sequence_id) as x, count(*) as w, {_T_SQL} as t from rec group by 1, 2, 3, 4, 5),
cell_ as (select subtype, segment, n, seed, x, w, t, i, h[33+16*i:48+16*i] as v from cls cross join unnest(range(n)) as u(i)),
eqc as materialized (select a.subtype, a.segment, a.n, a.seed, a.x as a, b.x as b, any_value(a.t) as t, count(*) as m from cell_ a join cell_ b on a.subtype = b.subtype and a.segment = b.segment and {LIKE_SQL} and a.i = b.i and a.v = b.v and a.x <> b.x group by 1, 2, 3, 4, 5, 6),
hop as (select subtype, segment, a as x, b as y from eqc where m >= t * n - 1e-9), reach as (select subtype, segment, x, x as y from cls union select r.subtype, r.segment, r.x, h.y from reach r join hop h on h.subtype = r.subtype and h.segment = r.segment and h.x = r.y),
comp as materialized (select subtype, segment, x, min(y) as c, count(*) as k from reach group by 1, 2, 3)"""
#: Average linkage, a merge in each group and step: lab holds the founder of each class that has a neighbour.
_AVERAGE = f"""{_CLASSES}, node as (select cls.*, comp.c from cls join comp using (subtype, segment, x) where k > 1),
link as materialized (select p.subtype, p.segment, p.n, p.x as a, q.x as b, p.c, p.w * q.w as ww, p.n - coalesce(e.m, 0) as d, p.t from node p join node q on q.subtype = p.subtype and q.segment = p.segment and q.c = p.c and q.x <> p.x left join eqc e on e.subtype = p.subtype and e.segment = p.segment and e.a = p.x and e.b = q.x),
lab as (select subtype, segment, x, x as f, 0 as step from comp where k > 1 union all
  select l.subtype, l.segment, l.x, coalesce(m.i, l.f), l.step + 1 from lab l
  join (select distinct subtype, segment, c from (select subtype, segment, c, i, j, s from (select p.subtype, p.segment, k.c, p.f as i, q.f as j, sum(k.ww * k.d)::double / sum(k.ww * k.n) as s, any_value(k.t) as t from link k
      join lab p on p.subtype = k.subtype and p.segment = k.segment and p.x = k.a join lab q on q.subtype = k.subtype and q.segment = k.segment and q.x = k.b where p.f < q.f group by 1, 2, 3, 4, 5) where s <= 1 - t + 1e-9)) g on g.subtype = l.subtype and g.segment = l.segment
  join comp o on o.subtype = l.subtype and o.segment = l.segment and o.x = l.x and o.c = g.c
  left join (select subtype, segment, c, i, j from (select p.subtype, p.segment, k.c, p.f as i, q.f as j, sum(k.ww * k.d)::double / sum(k.ww * k.n) as s, any_value(k.t) as t from link k
      join lab p on p.subtype = k.subtype and p.segment = k.segment and p.x = k.a join lab q on q.subtype = k.subtype and q.segment = k.segment and q.x = k.b where p.f < q.f group by 1, 2, 3, 4, 5)
      where s <= 1 - t + 1e-9 qualify row_number() over (partition by subtype, segment, c order by s, i, j) = 1) m on m.subtype = l.subtype and m.segment = l.segment and m.c = g.c and m.j = l.f),
fl as (select c.*, coalesce(l.f, c.x) as f from cls c left join (select subtype, segment, x, arg_max(f, step) as f from lab group by 1, 2, 3) l using (subtype, segment, x))"""
_SINGLE = f"{_CLASSES}, fl as (select cls.*, comp.c as f from cls join comp using (subtype, segment, x))"
#: From fl (a class with its founder f): clusters of two records or more with medoid, size, mean diameter and radius, and orphans.
_SPREAD = f"""kept as (select *, sum(w) over (partition by subtype, segment, n, seed, f) as size from fl), big as materialized (select * from kept where size >= 2),
cell as (select subtype, segment, n, seed, f, x, w, size, i, h[33+16*i:48+16*i] as v from big cross join unnest(range(n)) as u(i)),
own as (select subtype, segment, n, seed, f, x, any_value(w) as w, any_value(size) as size, sum(c) as same from (select *, sum(w) over (partition by subtype, segment, n, seed, f, i, v) as c from cell) group by 1, 2, 3, 4, 5, 6),
med as (select subtype, segment, n, seed, f, arg_min(x, {{'s': -same, 'x': x}}) as medoid, any_value(size) as size, 1 - sum(w * same)::double / (any_value(size)::double * any_value(size) * any_value(n)) as mean_diameter from own group by 1, 2, 3, 4, 5),
cen as materialized (select m.*, c.h, 'C' || row_number() over (partition by m.subtype, m.segment order by m.f, m.n, m.seed) as cluster_id from med m join cls c on c.subtype = m.subtype and c.segment = m.segment and c.x = m.medoid),
dis as (select b.subtype, b.segment, b.f, c.cluster_id, b.x, b.w, 1 - {equal_sql('b', 'c')} / b.n as d from big b join cen c on c.subtype = b.subtype and c.segment = b.segment and c.f = b.f and c.n = b.n and c.seed = b.seed),
rad as (select subtype, segment, cluster_id, quantile_cont(d, 0.9) as radius from (select *, unnest(range(w)) as copy from dis) group by 1, 2, 3),
clusters_ as (select c.subtype, c.segment, cluster_id, medoid, size::int as size, round(mean_diameter, 6) as mean_diameter, round(radius, 6) as radius from cen c join rad using (subtype, segment, cluster_id)),
alone as (select r.subtype, r.segment, r.sequence_id, r.n, r.seed, r.h from rec r join kept k on k.subtype = r.subtype and k.segment = r.segment and k.n = r.n and k.seed = r.seed and k.lanes = r.h[33:] where k.size < 2),
near as (select a.subtype, a.segment, a.sequence_id, arg_min({{'d': 1 - {equal_sql('a', 'b')} / a.n, 'c': b.cluster_id}}, {{'d': 1 - {equal_sql('a', 'b')} / a.n, 'c': b.cluster_id}}) as b from alone a join cen b on b.subtype = a.subtype and b.segment = a.segment and {LIKE_SQL} group by 1, 2, 3),
orphans_ as (select a.subtype, a.segment, a.sequence_id, b.c as nearest_cluster, round(b.d, 6) as nearest_distance from alone a left join near using (subtype, segment, sequence_id))"""


def _clusters(spark: SparkSession, d: str, linkage: str) -> DataFrame:
    c, _ = K.cluster_signatures(records(spark, d), C.Grouping(linkage=linkage, least=2))
    return c.select("subtype", "segment", "cluster_id", "medoid", "size", F.round("mean_diameter", 6).alias("mean_diameter"), F.round("radius", 6).alias("radius"))


def _orphans(spark: SparkSession, d: str, linkage: str) -> DataFrame:
    _, a = K.cluster_signatures(records(spark, d), C.Grouping(linkage=linkage, least=2))
    return a.where("is_orphan").select("subtype", "segment", "sequence_id", "nearest_cluster", F.round("nearest_distance", 6).alias("nearest_distance"))


@query(f"{_AVERAGE}, {_SPREAD} select * from clusters_")
def cluster_average(spark: SparkSession, d: str) -> DataFrame:
    """Average-linkage clusters of the records of all versions, each set of parameters apart, with medoid, size, diameter and radius."""
    return _clusters(spark, d, "average")


@query(f"{_AVERAGE}, {_SPREAD} select * from orphans_")
def cluster_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Orphans of the same clustering with the nearest cluster."""
    return _orphans(spark, d, "average")


@query(f"{_SINGLE}, {_SPREAD} select * from clusters_")
def cluster_single(spark: SparkSession, d: str) -> DataFrame:
    """Single-linkage clusters of the same records."""
    return _clusters(spark, d, "single")


@query(f"{_SINGLE}, {_SPREAD} select * from orphans_")
def cluster_single_orphans(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d, "single")


@query(f"{_SINGLE}, {_SPREAD}, o as (select subtype, segment, count(*) as k from orphans_ group by 1, 2), c as (select subtype, segment, count(*) as k from clusters_ group by 1, 2), a as (select subtype, segment, count(*) as k from rec group by 1, 2) select subtype, segment, coalesce(c.k, 0) as num_clusters, coalesce(o.k, 0) as num_orphans, a.k as num_records from a left join c using (subtype, segment) left join o using (subtype, segment)")
def cluster_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Clusters, orphans and records of each subtype and segment."""
    return K.cluster_metrics(K.cluster_signatures(records(spark, d), C.Grouping(linkage="single", least=2))[1])


@query(f"{WITH}, {REF}, m as (select a.subtype, a.segment, b.cluster_id, 1 - {equal_sql('a', 'b')} / a.n as d from us a join ref b on a.subtype = b.subtype and a.segment = b.segment and {LIKE_SQL} and concat_ws('/', a.cluster_version, a.cluster_id) = b.cluster_id where a.cluster_id is not null) select subtype, segment, cluster_id, count(*) as n, round(quantile_cont(d, 0.9), 9) as radius, round(avg(d), 9) as mean_distance from m group by 1, 2, 3")
def cluster_radius(spark: SparkSession, d: str) -> DataFrame:
    """Radius (90th percentile) and mean distance of the stored clusters' members to their centroid, all versions."""
    u = usable(spark, d).where("cluster_id is not null").select("subtype", "segment", "num_hashes", "seed", F.concat_ws("/", "cluster_version", "cluster_id").alias("cluster_id"), "lanes")
    keys = ["subtype", "segment", "cluster_id"]
    j = u.join(reference(spark, d), [*keys, "num_hashes", "seed"]).withColumns({"dist": Q.lane_distance("lanes", "centroid"), "w": F.lit(1)})
    return K.spread(j, keys).select(*keys, F.col("members").alias("n"), F.round("radius", 9).alias("radius"), F.round("mean_distance", 9).alias("mean_distance"))


@query(f"""with {ISO}, m as (select i.subtype, s.segment_name as segment, s.sequence_id, hex(s.kmer_signature) as h, octet_length(s.kmer_signature) as l from segment_kmers s join iso i using (sequence_id)),
w as (select *, case when l >= 16 then {word_sql(1)} end as nh, case when l >= 16 then {word_sql(9)} end as sd from m)
select subtype, segment, count(*) <> count(distinct sequence_id) as repeated, max(trim(sequence_id) = '') as blank, coalesce(min(nh) <> max(nh) or min(sd) <> max(sd), false) as mixed from w group by 1, 2""")
def input_faults(spark: SparkSession, d: str) -> DataFrame:
    """What each group of stored rows would be refused for: repeated or blank ids, mixed parameters."""
    s = table(spark, d, "segment_kmers").join(isolates(spark, d).select("sequence_id", "subtype"), "sequence_id").withColumnRenamed("segment_name", "segment")
    return K.input_faults(s, group=["subtype", "segment"])


# --- profiles -------------------------------------------------------------------------------------------------------------------


_ASSIGN = f"""with {ISO}, {CUR}, a as (select sequence_id, segment_name as segment, max(case when coalesce(is_orphan, 0) <> 1 then nullif(trim(cluster_id), '') end) as cluster_id from cur group by 1, 2),
g as (select i.sequence_id, d.ord, d.segment, a.cluster_id, case when a.cluster_id is not null then a.cluster_id when a.sequence_id is not null then '?' else '-' end as shown
from (select distinct sequence_id from a) i cross join (select unnest(range(8)) as ord, unnest({SEG_LIST}) as segment) d left join a on a.sequence_id = i.sequence_id and a.segment = d.segment),
p as (select sequence_id, string_agg(shown, '.' order by ord) as profile_string, string_agg(segment || ':' || shown, ' | ' order by ord) as segment_profile, count(cluster_id)::int as assigned_count,
count(cluster_id) / 8.0::double as completeness, count(cluster_id) = 8 as is_complete, coalesce(string_agg(segment, ',' order by ord) filter (shown = '-'), '') as missing_segments, coalesce(string_agg(segment, ',' order by ord) filter (shown = '?'), '') as orphan_segments from g group by 1)"""


def stored_profiles(spark: SparkSession, d: str) -> DataFrame:
    return G.profiles(G.assign_genotypes(assignments(spark, d)))


@query(f"{_ASSIGN} select * from p")
def genotype_profiles(spark: SparkSession, d: str) -> DataFrame:
    p = stored_profiles(spark, d).drop("segment_clusters")
    return p.withColumns({"missing_segments": F.concat_ws(",", "missing_segments"), "orphan_segments": F.concat_ws(",", "orphan_segments")})


@query(f"{_ASSIGN}, q as (select profile_string, count(*) as size, count(*) filter (is_complete) as c from p group by 1) select sum(size)::bigint as total, count(*) as unique_profiles, sum(c)::bigint as complete, sum(size - c)::bigint as partial, max(size) as largest_group, count(*) filter (size = 1) as singletons from q")
def genotype_summary(spark: SparkSession, d: str) -> DataFrame:
    return G.genotype_summary(stored_profiles(spark, d))


@query(f"{_ASSIGN} select profile_string, count(*) over (partition by profile_string) as size, min(sequence_id) over (partition by profile_string) as first_id, sequence_id from p")
def genotype_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every isolate with its group."""
    return G.genotype_groups(stored_profiles(spark, d))


@query(f"{_ASSIGN} select profile_string, count(*) as size from p group by 1")
def genotype_distribution(spark: SparkSession, d: str) -> DataFrame:
    return G.genotype_distribution(stored_profiles(spark, d))


@query(f"{_ASSIGN} select sequence_id, segment, case when shown <> '-' then shown end as cluster from g")
def segment_clusters(spark: SparkSession, d: str) -> DataFrame:
    """The map of a profile, one row a segment: ? for orphans, null for missing ones."""
    return stored_profiles(spark, d).select("sequence_id", F.explode("segment_clusters").alias("segment", "cluster"))


@query(f"""with {ISO}, {CUR}, a as (select sequence_id, segment_name as segment, max(trim(cluster_id)) as cluster_id from cur where coalesce(is_orphan, 0) <> 1 and nullif(trim(cluster_id), '') is not null group by 1, 2)
select i.sequence_id, d.segment, case when a.cluster_id is not null then 'ASSIGNED' when c.sequence_id is not null then 'ORPHAN' else 'MISSING' end as status from (select distinct sequence_id from a) i cross join (select unnest({SEG_LIST}) as segment) d
left join a on a.sequence_id = i.sequence_id and a.segment = d.segment left join cur c on c.sequence_id = i.sequence_id and c.segment_name = d.segment""")
def genotype_available(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of clustered segments only, with the valid sequences that have no cluster given beside them."""
    c = current(spark, d)
    return G.assign_genotypes(assignments(spark, d).where("not is_orphan"), c.select("sequence_id", F.col("segment_name").alias("segment"))).select("sequence_id", "segment", "status")


@query(f"""with {LONG}, h as (select cluster_id, min(sequence_id) as first_id from long where segment = 'HA' and cluster_id is not null group by 1),
n as (select a.sequence_id, h.first_id as other from long a join h using (cluster_id) where a.segment = 'HA')
select n.sequence_id as pair, count(*) filter (x.cluster_id = y.cluster_id) as matching, count(*) filter (x.cluster_id <> y.cluster_id) as differing, count(*) filter (x.cluster_id is null or y.cluster_id is null) as incomparable,
round(count(*) filter (x.cluster_id = y.cluster_id) / greatest(count(*) filter (x.cluster_id is not null and y.cluster_id is not null), 1), 6) as concordance
from n join long x on x.sequence_id = n.sequence_id join long y on y.sequence_id = n.other and y.segment = x.segment group by 1""")
def genotype_compare(spark: SparkSession, d: str) -> DataFrame:
    """Each isolate's profile against that of the first isolate of its HA cluster."""
    long = long_profiles(spark, d)
    ha = long.where("segment = 'HA' and cluster_id is not null")
    first = ha.groupBy("cluster_id").agg(F.min("sequence_id").alias("other"))
    pairs = ha.select("sequence_id", "cluster_id").join(first, "cluster_id").groupBy(F.col("sequence_id").alias("pair")).agg(F.min("other").alias("other"))
    cells = long.select("sequence_id", "segment", "cluster_id")
    a = pairs.select("pair").join(cells.withColumnRenamed("sequence_id", "pair"), "pair")
    b = pairs.join(cells.withColumnRenamed("sequence_id", "other"), "other").select("pair", "segment", "cluster_id")
    return G.compare(a, b).withColumn("concordance", F.round("concordance", 6))


# --- exports --------------------------------------------------------------------------------------------------------------------


@query(f"{_ASSIGN} select sequence_id, profile_string, '' as allele_string, '' as constellation_id, printf('%.3f', completeness) as completeness, case when is_complete then 'True' else 'False' end as is_complete, missing_segments, orphan_segments from p")
def genotypes_export(spark: SparkSession, d: str) -> DataFrame:
    return E.genotypes_tsv(stored_profiles(spark, d).withColumns({"allele_string": F.lit(None).cast("string"), "constellation_id": F.lit(None).cast("string")}))


@query("select distinct subtype, segment_name as segment, cluster_id, member_count::varchar as member_count, printf('%.4f', round(mean_diameter::decimal(18, 12), 4)) as mean_diameter from clusters where is_active = 1")
def clusters_export(spark: SparkSession, d: str) -> DataFrame:
    c = S.active_clusters(table(spark, d, "clusters")).select("subtype", F.col("segment_name").alias("segment"), "cluster_id", F.col("member_count").alias("size"), "mean_diameter")
    return E.clusters_tsv(c).distinct()


@query(f"{_NEAREST} select sequence_id, segment, n as nearest_cluster, printf('%.4f', round(d::decimal(18, 12), 4)) as nearest_distance from j where not inside and n is not null union all select sequence_id, segment, '', '' from j where n is null")
def orphans_export(spark: SparkSession, d: str) -> DataFrame:
    a = K.assign_to_existing(records(spark, d), reference(spark, d), LOOSE)
    return E.orphans_tsv(a.withColumn("nearest_distance", F.when(F.col("nearest_cluster").isNotNull(), F.col("distance"))))


@query(f"{_NEAREST} select segment, count(*)::varchar as orphan_count from j where not inside group by 1")
def orphan_counts_export(spark: SparkSession, d: str) -> DataFrame:
    return E.orphan_counts_tsv(K.assign_to_existing(records(spark, d), reference(spark, d), LOOSE))


# --- names ----------------------------------------------------------------------------------------------------------------------


def allele_rows(spark: SparkSession, d: str) -> DataFrame:
    """(sequence_id, ord, segment, allele) of each isolate's newest row with alleles, by their place in the profile."""
    g = table(spark, d, "genotypes").where("sequence_id is not null and trim(coalesce(allele_profile, '')) <> ''")
    g = S.latest(g.withColumn("_k", F.struct("created_at", "id")), ["sequence_id"], "_k")
    r = g.select("sequence_id", F.explode(F.split(F.upper(F.regexp_replace("allele_profile", r"\s+", "")), r"\|")).alias("allele")).where("allele not in ('', '?', '-')").distinct()
    seg = F.substring_index("allele", ".", 1)
    return r.select("sequence_id", G.ordinal(seg).alias("ord"), seg.alias("segment"), "allele").where("ord is not null")


ALLELES = f"""ag as (select * from genotypes where sequence_id is not null and trim(coalesce(allele_profile, '')) <> '' qualify row_number() over (partition by sequence_id order by created_at desc, id desc) = 1),
al as (select *, list_position({SEG_LIST}, segment)::int - 1 as ord from (select distinct sequence_id, allele, string_split(allele, '.')[1] as segment from (select sequence_id, unnest(string_split(upper(regexp_replace(allele_profile, '\\s+', '', 'g')), '|')) as allele from ag) where allele not in ('', '?', '-')) where list_position({SEG_LIST}, segment) > 0)"""


@query(f"""{WITH}, r as (select allele_name, segment_name as segment, subtype_num, h, n, seed from ({usable_sql('allele_registry', 'centroid_signature')}) where is_active = 1),
m as (select a.sequence_id, a.segment, b.allele_name, {equal_sql('a', 'b')} / a.n as sim, {_THRESHOLD_SQL.replace('case subtype', 'case a.subtype')} as t from rec a join r b on a.segment = b.segment and {LIKE_SQL} and b.subtype_num = case when a.subtype = 'H3N2' then 3 else 1 end where a.subtype in ('H3N2', 'H1N1pdm09'))
select sequence_id || '|' || segment as query_id, allele_name, round(sim, 6) as similarity from m where sim >= t - 1e-12 qualify row_number() over (partition by sequence_id, segment order by sim desc, allele_name) = 1""")
def allele_match(spark: SparkSession, d: str) -> DataFrame:
    """The best known allele of each record of a known subtype."""
    r = records(spark, d).where(F.col("subtype").isin(C.SUBTYPES))
    q = r.select(F.concat_ws("|", "sequence_id", "segment").alias("query_id"), "segment", "subtype", Q.subtype_number("subtype").alias("subtype_num"), "num_hashes", "seed", "lanes")
    q = K.with_threshold(q, LOOSE)
    h = Q.signature_header("centroid_signature")
    a = table(spark, d, "allele_registry").where("is_active = 1").where(Q.is_usable("centroid_signature")).select("allele_name", F.col("segment_name").alias("segment"), "subtype_num", h["num_hashes"].alias("num_hashes"), h["seed"].alias("seed"), Q.signature_lanes("centroid_signature").alias("lanes"))
    return N.best_match(q, a).withColumn("similarity", F.round("similarity", 6))


@query(f"""with {ISO}, {ALLELES}, c as (select al.sequence_id, i.subtype, count(*) as k, list_sort(list(struct_pack(o := ord, a := allele))) as l from (select sequence_id, ord, max(allele) as allele from al group by 1, 2) al join iso i using (sequence_id) where i.subtype in ('H3N2', 'H1N1pdm09') group by 1, 2),
s as (select sequence_id, subtype, k, array_to_string(list_transform(range(8), lambda o: coalesce(list_filter(l, lambda x: x.o = o)[1].a, '-')), '|') as combination from c),
f as (select combination, case arg_min(subtype, sequence_id) when 'H3N2' then 'H3N2' else 'H1N1' end || '-' || upper(sha256(combination)[1:12]) as cid from s where k >= 6 group by 1)
select sequence_id, s.combination, case when k >= 6 then cid end as constellation_id from s left join f using (combination)""")
def constellation_ids(spark: SparkSession, d: str) -> DataFrame:
    a = allele_rows(spark, d).groupBy("sequence_id", "segment").agg(F.max("allele").alias("allele"))
    i = isolates(spark, d).where(F.col("subtype").isin(C.SUBTYPES)).join(a.select("sequence_id").distinct(), "sequence_id", "left_semi")
    return N.constellations(a, i).select("sequence_id", "combination", "constellation_id")


@query("select segment_name, subtype_num, coalesce(max(allele_num), 0) + 1 as next_num from allele_registry group by 1, 2")
def next_allele_num(spark: SparkSession, d: str) -> DataFrame:
    return N.next_allele_numbers(table(spark, d, "allele_registry"))


@query("select segment_name as segment, subtype_num, count(*) as aliases, count(distinct allele_name) as alleles, count(centroid_signature) as indexed from allele_registry group by 1, 2")
def registry_summary(spark: SparkSession, d: str) -> DataFrame:
    return N.registry_summary(table(spark, d, "allele_registry"))


_FOUNDERS = f"""{WITH.replace('with ', 'with recursive ', 1)}, fd as (select subtype, segment, cluster_version, cluster_id, min(sequence_id) as first_id, arg_min(h, {{'s': sequence_id, 'v': created_at, 'i': id}}) as h from us where cluster_id is not null and trim(cluster_id) <> '' and subtype in ('H3N2', 'H1N1pdm09') group by 1, 2, 3, 4),
fo as materialized (select *, case when subtype = 'H3N2' then 3 else 1 end as num, {_T_SQL} as t, row_number() over (partition by segment order by first_id, subtype, cluster_id, cluster_version) as rn from fd),
rg as (select segment_name as segment, subtype_num as num, allele_num, coalesce(cluster_version, '') as v, internal_cluster_id as cid, allele_name as name, case when octet_length(centroid_signature) >= 24 then hex(centroid_signature)[33:] else '' end as h from allele_registry where is_active = 1),
rl as (select segment, list({{'num': num, 'v': v, 'cid': cid, 'name': name, 'h': h, 'an': allele_num}}) as held from rg group by 1),
st as (select segment, 0 as step, held, null::varchar as name, null::varchar as how, null::double as sim, null::int as an from (select s.segment, coalesce(held, []) as held from (select distinct segment from fo) s left join rl using (segment)) union all
  select segment, step, case when how in ('minted', 'matched', 'other_subtype') then list_append(held, {{'num': num, 'v': v, 'cid': cid, 'name': name, 'h': case when how = 'minted' then h else '' end, 'an': coalesce(an, 0)}}) else held end, name, how, sim, an from (
    select *, coalesce(known, own.name, oth.name, segment || '.' || num || '.' || lpad(nxt::varchar, 4, '0')) as name, case when known is not null then 'known' when own is not null then 'matched' when oth is not null then 'other_subtype' else 'minted' end as how,
      case when known is null then coalesce(-own.d, -oth.d) end as sim, case when known is null and own is null and oth is null then nxt end as an from (
      select *, list_sort(list_filter(cand, lambda c: c.num = num).list_transform(lambda c: {{'d': c.d, 'name': c.name}}))[1] as own, list_sort(list_filter(cand, lambda c: c.num <> num).list_transform(lambda c: {{'d': c.d, 'name': c.name}}))[1] as oth from (
        select st.segment, st.step + 1 as step, st.held, f.num, coalesce(f.cluster_version, '') as v, f.cluster_id as cid, f.h[33:] as h,
          list_filter(st.held, lambda c: c.num = f.num and c.v = coalesce(f.cluster_version, '') and c.cid = f.cluster_id)[1].name as known, coalesce(list_max(list_transform(list_filter(st.held, lambda c: c.num = f.num), lambda c: c.an)), 0) + 1 as nxt,
          list_filter(list_transform(list_filter(st.held, lambda c: length(c.h) = length(f.h) - 32), lambda c: {{'num': c.num, 'name': c.name, 'd': -list_sum(list_transform(range(length(c.h) // 16), lambda i: (c.h[1+16*i:16+16*i] = f.h[33+16*i:48+16*i])::int)) / (length(c.h) // 16)}}), lambda c: -c.d >= f.t - 1e-12) as cand
        from st join fo f on f.segment = st.segment and f.rn = st.step + 1))))
select fo.segment, fo.subtype, fo.cluster_version, fo.cluster_id, st.name as allele_name, st.how, round(st.sim, 6) as similarity, fo.num as subtype_num, st.an as allele_num from st join fo on fo.segment = st.segment and fo.rn = st.step"""


@query(_FOUNDERS)
def allele_naming(spark: SparkSession, d: str) -> DataFrame:
    """Names for the founders of the stored clusters of all versions against the registry, in order; minted ones count at once."""
    u = usable(spark, d).where("cluster_id is not null and trim(cluster_id) <> ''").where(F.col("subtype").isin(C.SUBTYPES))
    f = u.groupBy("subtype", "segment", "cluster_version", "cluster_id").agg(F.min("sequence_id").alias("first_id"), F.min_by("kmer_signature", F.struct("sequence_id", "created_at", "id")).alias("sig"))
    f = f.select("subtype", "segment", "cluster_version", "cluster_id", "first_id", Q.signature_lanes("sig").alias("lanes"), F.lit(False).alias("late"))
    r = table(spark, d, "allele_registry").where("is_active = 1").select(F.col("segment_name").alias("segment"), "subtype_num", "allele_name", "allele_num", "internal_cluster_id", "cluster_version", Q.signature_lanes("centroid_signature").alias("lanes"))
    return N.assign_alleles(f, r)[0].withColumn("similarity", F.round("similarity", 6))


# --- the staged screen -------------------------------------------------------------------------------------------------------------

def _scores_sql(mine: str, population: str, stouffer: bool = False) -> str:
    """SQL for p (pairs), cnt (counts), fi (tests) over a population and scores of some isolates."""
    pairs = lambda t: f"select a.sequence_id, a.segment as seg_a, b.segment as seg_b, a.cluster_id as ca, b.cluster_id as cb from {t} a join {t} b on a.sequence_id = b.sequence_id and a.ord < b.ord where a.cluster_id is not null and b.cluster_id is not null"
    lf = "lgamma(({})::double + 1)".format
    pmf = f"exp({lf('n_a')} + {lf('total - n_a')} + {lf('n_b')} + {lf('total - n_b')} - {lf('total')} - {lf('x')} - {lf('n_a - x')} - {lf('n_b - x')} - {lf('total - n_a - n_b + x')})"
    poly = lambda c, x: "(" + " + ".join(f"({v!r}::double) * pow({x}, {i})" for i, v in enumerate(c)) + ")"
    (a, b), (c, d), (e, f) = T.QUANTILE
    tail = f"case when r <= 5 then {poly(c, '(r - 1.6)')} / {poly(d, '(r - 1.6)')} else {poly(e, '(r - 5)')} / {poly(f, '(r - 5)')} end"
    z = f"case when abs(y) <= 0.425 then y * {poly(a, '(0.180625 - y * y)')} / {poly(b, '(0.180625 - y * y)')} else sign(y) * ({tail}) end"
    # the upper tail of the normal law by Simpson's rule; |z| beyond 40 has none
    simpson = "list_sum(list_transform(range(2001), lambda i: (case when i in (0, 2000) then 1 when i % 2 = 1 then 4 else 2 end) * exp(-power(abs(t) + i * 0.005, 2) / 2))) * 0.005 / 3 / sqrt(2 * pi())"
    end = (
        f"sq as (select sequence_id, segment, y, sqrt(-ln(least(p, 1 - p))) as r from (select *, p - 0.5 as y from (select sequence_id, segment, greatest(least(p, 1 - 1e-15), 1e-15) as p from q))), "
        f"sc as (select sequence_id, segment, sum({z}) / sqrt(count(*)) as t from sq group by 1, 2), scores as (select sequence_id, segment, case when t > 0 then 1 - {simpson} else {simpson} end as p from sc)"
        if stouffer
        else "sc as (select sequence_id, segment, avg(case when p < 1e-15 then 1 / (p * pi()) else tan((0.5 - p) * pi()) end) as t from q group by 1, 2), scores as (select sequence_id, segment, least(1.0, greatest(0.0, case when t > 1e15 then 1 / t / pi() else 0.5 - atan(t) / pi() end)) as p from sc)"
    )
    return f"""p as ({pairs(mine)}), pp as ({pairs(population)}), ab as (select seg_a, seg_b, ca, cb, count(*) as n_ab from pp group by all),
cnt as (select *, (sum(n_ab) over (partition by seg_a, seg_b, ca))::bigint as n_a, (sum(n_ab) over (partition by seg_a, seg_b, cb))::bigint as n_b, (sum(n_ab) over (partition by seg_a, seg_b))::bigint as total from ab),
fx as (select seg_a, seg_b, ca, cb, n_ab, n_a, n_b, total, unnest(range(greatest(0, n_a + n_b - total), n_ab + 1)) as x from cnt), fi as (select seg_a, seg_b, ca, cb, n_ab, n_a, n_b, total, case when n_a = total or n_b = total or n_ab = least(n_a, n_b) then 1.0 else least(1.0, sum({pmf})) end as p from fx group by seg_a, seg_b, ca, cb, n_ab, n_a, n_b, total),
q as (select p.sequence_id, unnest([p.seg_a, p.seg_b]) as segment, least(greatest(fi.p, 1e-300), 1 - 1e-15) as p from p join fi using (seg_a, seg_b, ca, cb)), {end}"""


def _stage1_sql(least: float) -> str:
    """SQL for events of the scores under a false discovery rate of 0.05."""
    return f"""fd as (select sequence_id, segment, p, row_number() over (order by p) as r, count(*) over () as m from scores), fq as (select sequence_id, segment, p, min(p * m / r) over (order by r rows between current row and unbounded following) as q from fd),
e1 as (select sequence_id, {_EVENT_COLS}, avg(p) as mean_p from fq where q < 0.05 group by 1), s1 as (select sequence_id, {_TYPE_SQL} as event_type, 1 as stage, discordant_segments, least(1.0, greatest(0.0, (1 - mean_p) * {_COHERENCE})) as confidence from e1), ev1 as (select * from s1 where confidence >= {least})"""


LONG_ALL = LONG.replace(", long as", ", long_all as")
_COUNTS = _FISHER = _SCORES = f"with {LONG}, {_scores_sql('long', 'long')}"


@query(f"{_COUNTS} select * from cnt")
def ld_pair_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.pattern_counts(R.pair_rows(long_profiles(spark, d)))


@query(f"{_FISHER} select seg_a, seg_b, ca, cb, round(p, 6) as p from fi")
def fisher_less(spark: SparkSession, d: str) -> DataFrame:
    return R.fisher_patterns(R.pattern_counts(R.pair_rows(long_profiles(spark, d)))).select("seg_a", "seg_b", "ca", "cb", F.round("p", 6).alias("p"))


@query(f"{_SCORES} select sequence_id, segment, round(p, 5) as p from scores")
def segment_scores(spark: SparkSession, d: str) -> DataFrame:
    return R.segment_scores(long_profiles(spark, d)).withColumn("p", F.round("p", 5))


def _fdr_sql(c: str) -> str:
    return f"{_FISHER}, v as (select seg_a, seg_b, ca, cb, p, row_number() over (order by p) as r, count(*) over () as m from fi) select seg_a, seg_b, ca, cb, round(least(1.0, min(p * m * {c} / r) over (order by r rows between current row and unbounded following)), 6) as q from v"


@query(_fdr_sql("1.0"))
def fdr_bh(spark: SparkSession, d: str) -> DataFrame:
    """Adjusted p-values of all cluster combinations."""
    f = stage(R.fisher_patterns(R.pattern_counts(R.pair_rows(long_profiles(spark, d)))), "fisher")
    return T.fdr_adjust(f, "p").select("seg_a", "seg_b", "ca", "cb", F.round("q", 6).alias("q"))


@query(_fdr_sql("(select sum(1.0::double / i) from range(1, (select count(*) from fi) + 1) t(i))"))
def fdr_by(spark: SparkSession, d: str) -> DataFrame:
    f = stage(R.fisher_patterns(R.pattern_counts(R.pair_rows(long_profiles(spark, d)))), "fisher")
    return T.fdr_adjust(f, "p", "by").select("seg_a", "seg_b", "ca", "cb", F.round("q", 6).alias("q"))


@query(f"with {LONG}, {_scores_sql('long', 'long', True)} select sequence_id, segment, round(p, 6) as p from scores")
def stouffer_scores(spark: SparkSession, d: str) -> DataFrame:
    return R.segment_scores(long_profiles(spark, d), "stouffer").withColumn("p", F.round("p", 6))


def _stage0_sql() -> str:
    return f"""{ALLELES}, n as (select *, try_cast(nullif(regexp_extract(allele, '^[A-Z0-9]+\\.(\\d+)\\.\\d+$', 1), '') as int) as num from al),
k as (select sequence_id, num, count(*) as k, min(ord) as f from n where num is not null group by 1, 2), m as (select sequence_id, num as majority from k qualify row_number() over (partition by sequence_id order by k desc, f) = 1),
o as (select distinct sequence_id, majority, segment, ord from n join m using (sequence_id) where num <> majority), e0 as (select sequence_id, {_EVENT_COLS} from o group by 1)"""


_IN = lambda g: "(" + ", ".join(f"'{s}'" for s in g) + ")"
#: The segments of an event in order, and how many of them are of each group.
_EVENT_COLS = f"array_to_string(list_sort(list(distinct list_position({SEG_LIST}, segment) || ':' || segment)).list_transform(lambda x: x[3:]), ',') as discordant_segments, count(distinct segment) as k, count(distinct segment) filter (segment in ('HA', 'NA')) as surface, " + ", ".join(f"count(distinct segment) filter (segment in {_IN(g)}) as k{i}" for i, g in enumerate(C.CO_GROUPS))
_COHERENCE = " * ".join(f"(case when k{i} = 0 then 1.0::double when k{i} = {len(g)} then 1.15::double else 0.8::double + 0.2::double * k{i} / {len(g)} end)" for i, g in enumerate(C.CO_GROUPS))
_TYPE_SQL = "case when surface = k or surface = 0 then 'surface_internal' when k = 1 then 'single_segment' else 'complex' end"
_STAGE0 = f"with {_stage0_sql()}"


@query(f"{_STAGE0} select sequence_id, majority, string_agg(segment, ',' order by ord) as discordant_segments from o group by 1, 2")
def stage0_majority(spark: SparkSession, d: str) -> DataFrame:
    e = R.screen_alleles(allele_rows(spark, d))
    return e.select("sequence_id", F.get_json_object("evidence", "$.majority").cast("int").alias("majority"), F.concat_ws(",", "discordant_segments").alias("discordant_segments"))


@query(f"{_STAGE0} select sequence_id, {_TYPE_SQL} as event_type, round(least(1.0, {_COHERENCE}), 6)::double as confidence from e0")
def stage0_coherence(spark: SparkSession, d: str) -> DataFrame:
    return R.screen_alleles(allele_rows(spark, d)).select("sequence_id", "event_type", F.round("confidence", 6).alias("confidence"))


def ha_keys(spark: SparkSession, d: str) -> DataFrame:
    """Constellations by the HA cluster alone, so that groups are large enough to score."""
    return R.constellation_keys(long_profiles(spark, d).where("segment = 'HA'"))


def lanes_of(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("sequence_id", "segment", "num_hashes", "seed", "lanes")


_HA_KEYS = "ky as (select sequence_id, '-.-.-.' || case when status = 'ORPHAN' then '?' else coalesce(cluster_id, '-') end || '.-.-.-.-' as key from long where segment = 'HA')"


def _stage2_sql(keys: str) -> str:
    return f"""{keys}, kk as (select * from ky where key in (select key from ky group by 1 having count(*) > 3)), r as (select concat_ws('|', key, n, seed) as key, segment, sequence_id, h, n from rec join kk using (sequence_id)),
bn as (select *, row_number() over (partition by key, segment order by md5(sequence_id), sequence_id) - 1 as rk from r), bm as (select *, count(*) over (partition by key, segment) as m from bn where rk <= 500),
dd as (select a.key, a.segment, a.sequence_id as a, b.sequence_id as b, 1 - {equal_sql('a', 'b')} / a.n as d from bm a join bm b on a.key = b.key and a.segment = b.segment
  where case when a.m * (a.m - 1) / 2 <= 500 then a.rk < b.rk else ((b.rk - a.rk + a.m) % a.m - 1) * a.m + a.rk < 500 and a.rk <> b.rk end),
mates as (select a.key, a.segment, a.sequence_id, count(*) as n, sum(1 - {equal_sql('a', 'b')} / a.n) as s from r a join r b on a.key = b.key and a.segment = b.segment and a.sequence_id <> b.sequence_id group by 1, 2, 3),
own as (select key, segment, s as sequence_id, count(*) as bn, sum(d) as bs, sum(d * d) as bq from (select key, segment, unnest([a, b]) as s, d from dd) group by 1, 2, 3),
g as (select key, segment, count(*) as gn, sum(d) as gs, sum(d * d) as gq from dd group by 1, 2), b as (select segment, sum(gn) as tn, sum(gs) as ts, sum(gq) as tq from g group by 1),
l as (select m.*, gn - coalesce(bn, 0) as ln, gs - coalesce(bs, 0) as ls, gq - coalesce(bq, 0) as lq, tn, ts, tq from mates m join g using (key, segment) join b using (segment) left join own using (key, segment, sequence_id)),
z as (select sequence_id, segment, s / n as mean, case when ln >= 3 then ls / ln else ts / tn end as mu, greatest(0.01, case when ln >= 3 then sqrt(greatest(0.0, lq / ln - power(ls / ln, 2))) else sqrt(greatest(0.0, tq / tn - power(ts / tn, 2))) end) as sigma from l where n >= 3)"""


def _stage2_events_sql(least: float) -> str:
    return f"""e2 as (select sequence_id, {_EVENT_COLS}, avg((mean - mu) / sigma) as mean_z from z where (mean - mu) / sigma > 2 group by 1),
s2 as (select sequence_id, {_TYPE_SQL} as event_type, 2 as stage, discordant_segments, least(1.0, (1 - exp(-0.3 * mean_z)) * {_COHERENCE}) as confidence from e2), ev2 as (select * from s2 where confidence >= {least})"""


_STAGE2 = f"with {ISO}, {SEG}, {REC}, {LONG}, {_stage2_sql(_HA_KEYS)}"


@query(f"{_STAGE2} select sequence_id, segment, round(mean, 9) as mean, round(mu, 9) as mu, round(sigma, 5) as sigma, round((mean - mu) / sigma, 4) as z from z")
def stage2_zscores(spark: SparkSession, d: str) -> DataFrame:
    z = R.distance_scores(ha_keys(spark, d), lanes_of(spark, d))
    return z.select("sequence_id", "segment", F.round("mean", 9).alias("mean"), F.round("mu", 9).alias("mu"), F.round("sigma", 5).alias("sigma"), F.round("z", 4).alias("z"))


def _events(e: DataFrame) -> DataFrame:
    return e.select("sequence_id", "event_type", "stage", F.concat_ws(",", "discordant_segments").alias("discordant_segments"), F.round("confidence", 5).alias("confidence"))


_SHOWN = "sequence_id, event_type, stage, discordant_segments, round(confidence, 5)::double as confidence"


@query(f"{_STAGE2}, {_stage2_events_sql(0.3)} select {_SHOWN} from ev2")
def stage2_events(spark: SparkSession, d: str) -> DataFrame:
    return _events(R.stage2_events(ha_keys(spark, d), lanes_of(spark, d), C.Screen(least_confidence=0.3)))


#: The whole screen: stage 0, then stages 1 and 2 over analysable isolates without an earlier event; keys are the eight clusters.
_SCREEN = f"""with {ISO}, {SEG}, {REC}, {_stage0_sql()}, ev0 as (select sequence_id, {_TYPE_SQL} as event_type, 0 as stage, discordant_segments, least(1.0, {_COHERENCE}) as confidence from e0),
{LONG_ALL}, ok as (select sequence_id from long_all group by 1 having count(cluster_id) >= 6), long as (select * from long_all where sequence_id in (from ok) and sequence_id not in (select sequence_id from ev0)), {_scores_sql('long', 'long')}, {_stage1_sql(0.7)},
ky as (select sequence_id, string_agg(case when status = 'ORPHAN' then '?' else coalesce(cluster_id, '-') end, '.' order by ord) as key from (select i.sequence_id, g.ord, long.status, long.cluster_id from (select distinct sequence_id from long) i cross join (select unnest(range(8)) as ord) g left join long on long.sequence_id = i.sequence_id and long.ord = g.ord) group by 1),
{_stage2_sql('').removeprefix(', ')}, {_stage2_events_sql(0.7)}"""


@query(f"{_SCREEN} select {_SHOWN} from ev0 union all select {_SHOWN} from ev1 union all select {_SHOWN} from ev2 where sequence_id not in (select sequence_id from ev1)")
def reassortment_events(spark: SparkSession, d: str) -> DataFrame:
    """All three stages over the stored profiles, alleles and signatures."""
    return _events(R.detect(long_profiles(spark, d), lanes_of(spark, d), allele_rows(spark, d)))


@query(f"{_SCREEN}, f as (select count(*) as flagged from ev0) select flagged, analysed, case when analysed > 0 then flagged / analysed else 0.0 end as rate from f cross join (select count(distinct sequence_id) as analysed from ok)")
def reassortment_rate(spark: SparkSession, d: str) -> DataFrame:
    """Isolates with a stage 0 event over analysable ones."""
    return R.reassortment_rate(R.screen_alleles(allele_rows(spark, d)), R.analysable(long_profiles(spark, d)).select("sequence_id"))


@query(f"{_SCREEN} select sequence_id, stage::varchar as detection_stage, event_type, discordant_segments, printf('%.4f', round(confidence::decimal(18, 12), 4)) as confidence from ev0")
def events_export(spark: SparkSession, d: str) -> DataFrame:
    return E.events_tsv(R.screen_alleles(allele_rows(spark, d))).drop("description")


_VALID = f"""with {LONG_ALL}, ok as (select sequence_id from long_all group by 1 having count(cluster_id) >= 6), long as (select * from long_all where sequence_id in (from ok)), {_scores_sql('long', 'long')}, {_stage1_sql(0.5)}"""


@query(f"{_VALID} select {_SHOWN} from ev1")
def stage1_events(spark: SparkSession, d: str) -> DataFrame:
    return _events(R.stage1_events(R.analysable(long_profiles(spark, d)), C.Screen(least_confidence=0.5)))


@query(f"{_VALID}, n as (select sequence_id, count(*) as n_tested from scores group by 1) select ev1.sequence_id, segment, round(p, 6) as observed, n_tested, 0.05 / n_tested as alpha from ev1 join scores using (sequence_id) join n using (sequence_id) where list_contains(string_split(discordant_segments, ','), segment)")
def validation_observed(spark: SparkSession, d: str) -> DataFrame:
    """What a permutation check starts from: observed scores of the events' segments, and the level their isolate's share."""
    long = long_profiles(spark, d)
    ev = R.stage1_events(R.analysable(long), C.Screen(least_confidence=0.5))
    return R.observed_scores(stage(ev, "events"), long).withColumn("observed", F.round("observed", 6))


@query()
def permutation_validation(spark: SparkSession, d: str) -> DataFrame:
    """Empirical p-values of the stage 1 events; their law is tested against plain permutations."""
    long = stage(long_profiles(spark, d), "long")
    screen = C.Screen(least_confidence=0.5)
    return R.validate_events(stage(R.stage1_events(R.analysable(long), screen), "events"), long, screen, 1000)


@query(f"{_VALID}, n as (select sequence_id, count(*) as n from scores group by 1) select sequence_id, segment, p < 0.05 / n as flagged from scores join n using (sequence_id)")
def bonferroni_flags(spark: SparkSession, d: str) -> DataFrame:
    """Scores against the level divided by their isolate's tests."""
    s = R.segment_scores(R.analysable(long_profiles(spark, d)))
    return R.significant(s, C.Screen(correction="per_profile_bonferroni")).select("sequence_id", "segment", "flagged")


@query(f"""with {_stage0_sql()}, l as (select distinct least(a.allele_name, b.allele_name) as x, greatest(a.allele_name, b.allele_name) as y from allele_registry a join allele_registry b on a.segment_name = b.segment_name and a.allele_num = b.allele_num and a.subtype_num < b.subtype_num),
w as (select x as a, y as b from l union select y, x from l) select e0.sequence_id, coalesce(string_agg(distinct w.b, ',' order by w.b), '') as links from e0 join (select sequence_id, allele from n join m using (sequence_id) where num <> majority) d using (sequence_id) left join w on w.a = d.allele group by 1""")
def stage0_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Links of the discordant alleles of stage 0 events."""
    e = R.screen_alleles(allele_rows(spark, d), lineage=registry_links(spark, d))
    return e.select("sequence_id", F.array_join(F.from_json(F.get_json_object("evidence", "$.links"), "array<string>"), ",").alias("links"))


# --- stored tables -------------------------------------------------------------------------------------------------------------------


@query("select cluster_version from segment_kmers where cluster_version is not null order by created_at desc, cluster_version desc limit 1")
def latest_version(spark: SparkSession, d: str) -> DataFrame:
    return D.latest_version(table(spark, d, "segment_kmers"))


@query("select segment_name, subtype, version from clusters where is_active = 1 qualify row_number() over (partition by segment_name, subtype order by created_at desc, version desc) = 1")
def latest_cluster_version(spark: SparkSession, d: str) -> DataFrame:
    return S.latest_cluster_version(table(spark, d, "clusters"))


@query("select cluster_id, segment_name, subtype, version, member_count from clusters where is_active = 1")
def active_clusters(spark: SparkSession, d: str) -> DataFrame:
    return S.active_clusters(table(spark, d, "clusters")).select("cluster_id", "segment_name", "subtype", "version", "member_count")


@query(f"with {SEG} select sequence_id, segment_name, cluster_version, cluster_id, is_orphan from seg")
def latest_segments(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).select("sequence_id", "segment_name", "cluster_version", "cluster_id", "is_orphan")


@query("select sequence_id, genotype_profile, constellation_id from (select distinct * from genotypes where sequence_id is not null) qualify row_number() over (partition by sequence_id order by created_at desc, id desc) = 1")
def latest_genotype(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "genotypes").where("sequence_id is not null")
    return S.latest(g.withColumn("_k", F.struct("created_at", "id")), ["sequence_id"], "_k").select("sequence_id", "genotype_profile", "constellation_id")


@query("select distinct segment_name, sequence_id from incoming_segments i where sequence_id is not null and not exists (select 1 from segment_kmers s where s.sequence_id = i.sequence_id)")
def skip_existing(spark: SparkSession, d: str) -> DataFrame:
    new = table(spark, d, "incoming_segments").where("sequence_id is not null").select("segment_name", "sequence_id").distinct()
    return S.without_known(new, table(spark, d, "segment_kmers"))


@query(f"with {ISO}, {SEG} select s.sequence_id, s.segment_name, s.cluster_version, i.subtype, s.allele_id from seg s join (select distinct sequence_id, subtype from iso) i using (sequence_id) where s.kmer_signature is not null and s.allele_id is not null")
def repair_affected(spark: SparkSession, d: str) -> DataFrame:
    """Signatures with an allele and their isolate's subtype: what a repair of a name picks from."""
    return S.segment_signatures(segments(spark, d), isolates(spark, d)).where("allele_id is not null").select("sequence_id", "segment_name", "cluster_version", "subtype", "allele_id")


def registry_links(spark: SparkSession, d: str) -> DataFrame:
    """(allele_a, allele_b): alleles of one segment and number in two subtypes."""
    r = table(spark, d, "allele_registry")
    a, b = r.select("segment_name", "allele_num", F.col("subtype_num").alias("na"), F.col("allele_name").alias("x")), r.select("segment_name", "allele_num", F.col("subtype_num").alias("nb"), F.col("allele_name").alias("y"))
    return a.join(b, ["segment_name", "allele_num"]).where("na < nb").select(F.least("x", "y").alias("allele_a"), F.greatest("x", "y").alias("allele_b")).distinct()


@query("""with l as (select distinct least(a.allele_name, b.allele_name) as a, greatest(a.allele_name, b.allele_name) as b from allele_registry a join allele_registry b on a.segment_name = b.segment_name and a.allele_num = b.allele_num and a.subtype_num < b.subtype_num)
select a as allele, b as other from l union select b, a from l""")
def lineage_union(spark: SparkSession, d: str) -> DataFrame:
    """Those alleles as links in both directions."""
    return S.lineage_of(registry_links(spark, d))


@query("select distinct subtype, status, sequence_id from sequences where subtype is not null")
def sequences_by_subtype(spark: SparkSession, d: str) -> DataFrame:
    """The isolates of each subtype and status, looked up one subtype after another."""
    s = table(spark, d, "sequences")
    kinds = [r[0] for r in s.select("subtype").where("subtype is not null").distinct().collect()]  # a few spellings
    out = None
    for k in kinds:
        got = S.sequences_of(s, k).select("subtype", "status", "sequence_id").distinct()
        out = got if out is None else out.union(got)
    return out


@query("select segment_name, subtype_num, allele_name, allele_num from allele_registry where is_active = 1")
def alleles_of_segments(spark: SparkSession, d: str) -> DataFrame:
    """Active alleles, looked up by segment."""
    r, out = table(spark, d, "allele_registry"), None
    for s in C.SEGMENTS:
        got = S.alleles_of(r, s)
        out = got if out is None else out.union(got)
    return out.select("segment_name", "subtype_num", "allele_name", "allele_num")


@query(f"""with {ISO}, {CUR}, k as (select distinct segment_name, case when i.subtype = 'H3N2' then 3 else 1 end as subtype_num, cluster_version, cluster_id as internal_cluster_id from cur join iso i using (sequence_id) where i.subtype in ('H3N2', 'H1N1pdm09'))
select k.*, r.allele_name from k left join (select distinct segment_name, subtype_num, coalesce(cluster_version, '') as v, internal_cluster_id, allele_name from allele_registry) r on r.segment_name = k.segment_name and r.subtype_num = k.subtype_num and r.v = coalesce(k.cluster_version, '') and r.internal_cluster_id = k.internal_cluster_id""")
def allele_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The name that the registry has for each cluster in use, null if none."""
    s = current(spark, d).join(isolates(spark, d).select("sequence_id", "subtype"), "sequence_id").where(F.col("subtype").isin(C.SUBTYPES))
    k = s.select("segment_name", Q.subtype_number("subtype").alias("subtype_num"), "cluster_version", F.col("cluster_id").alias("internal_cluster_id")).distinct()
    r = table(spark, d, "allele_registry").select("segment_name", "subtype_num", "cluster_version", "internal_cluster_id", "allele_name").distinct()
    return N.allele_name_of(r, k)


# --- triage reports ---------------------------------------------------------------------------------------------------------------------


@query(f"with {ISO}, {CUR} select i.subtype, segment_name, count(*) filter (is_orphan = 1) as orphans, count(*) as total, round(count(*) filter (is_orphan = 1) / count(*), 6) as rate from cur join iso i using (sequence_id) group by 1, 2")
def orphan_rates(spark: SparkSession, d: str) -> DataFrame:
    return D.orphan_rates(current(spark, d), isolates(spark, d)).withColumn("rate", F.round("rate", 6))


@query(f"with {ISO}, {CUR} select orphaned, count(*) as isolates from (select count(*) filter (is_orphan = 1) as orphaned from cur group by sequence_id) group by 1")
def orphan_histogram(spark: SparkSession, d: str) -> DataFrame:
    return D.orphan_histogram(current(spark, d))


@query(f"with {ISO}, {CUR} select count(*) filter (o > 0) as any_orphaned, count(*) filter (o = n) as all_orphaned, count(*) as isolates from (select count(*) filter (is_orphan = 1) as o, count(*) as n from cur group by sequence_id)")
def orphan_totals(spark: SparkSession, d: str) -> DataFrame:
    return D.orphan_totals(current(spark, d))


@query(f"with {ISO}, {CUR}, r as (select distinct allele_name, max(is_active) as m from allele_registry group by 1) select segment_name, count(*) filter (m = 1) as minted, count(*) filter (m <> 1 or (m is null and allele_id is not null)) as joined, count(*) filter (allele_id is null) as unnamed from cur left join r on r.allele_name = cur.allele_id where is_orphan = 1 group by 1")
def orphan_minted_joined(spark: SparkSession, d: str) -> DataFrame:
    """Orphans whose allele is active in the registry, retired or unknown, or missing."""
    r = table(spark, d, "allele_registry").groupBy("allele_name").agg(F.max("is_active").alias("minted"))
    return D.minted_or_joined(current(spark, d), r)


@query(f"with {ISO}, {CUR} select segment_name, count(*) as n, round(quantile_cont(distance_to_centroid, 0.1), 9) as p10, round(quantile_cont(distance_to_centroid, 0.5), 9) as p50, round(quantile_cont(distance_to_centroid, 0.9), 9) as p90, round(max(distance_to_centroid), 9) as max from cur where is_orphan = 1 and distance_to_centroid is not null and not isnan(distance_to_centroid) group by 1")
def orphan_percentiles(spark: SparkSession, d: str) -> DataFrame:
    o = D.orphan_distances(current(spark, d))
    return o.select("segment_name", "n", *(F.round(c, 9).alias(c) for c in ("p10", "p50", "p90", "max")))


@query(f"with {ISO}, {CUR} select segment_name, round(o, 8) as orphan_mean, round(c, 8) as clustered_mean, round(case when o <> 0 and c <> 0 then o - c end, 8) as delta from (select segment_name, avg(sequence_length) filter (is_orphan = 1) as o, avg(sequence_length) filter (is_orphan = 0) as c from cur group by 1)")
def orphan_length_skew(spark: SparkSession, d: str) -> DataFrame:
    s = D.length_skew(current(spark, d))
    return s.select("segment_name", *(F.round(c, 8).alias(c) for c in ("orphan_mean", "clustered_mean", "delta")))


@query(f"""with {ISO}, {CUR}, per as (select sequence_id, count(*) filter (is_orphan = 1) / count(*) as f from cur group by 1),
kv as (select sequence_id, k as key, try_cast(json_extract_string(metadata_json, '$.' || k) as double) as v from (select sequence_id, metadata_json, unnest(json_keys(metadata_json)) as k from iso where json_valid(metadata_json)))
select key, round(avg(v) filter (f >= 0.5), 8) as heavy_mean, round(avg(v) filter (f < 0.5), 8) as rest_mean, count(*) filter (f >= 0.5) as heavy_n, count(*) filter (f < 0.5) as rest_n from kv join per using (sequence_id) where v is not null group by 1""")
def orphan_metadata_skew(spark: SparkSession, d: str) -> DataFrame:
    m = D.metadata_skew(current(spark, d), isolates(spark, d))
    return m.select("key", F.round("heavy_mean", 8).alias("heavy_mean"), F.round("rest_mean", 8).alias("rest_mean"), "heavy_n", "rest_n")


@query("select segment_name, count(*) as clusters, sum(member_count)::bigint as members, min(member_count) as smallest, max(member_count) as largest from clusters group by 1")
def cluster_context(spark: SparkSession, d: str) -> DataFrame:
    return D.cluster_context(table(spark, d, "clusters"))
