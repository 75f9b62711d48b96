"""Column functions on headers, sequences and k-mers; all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from octoseg import config as C


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def literal_map(d: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in d.items() for x in kv))


def clean_sequence(seq: str | Column) -> Column:
    """Without white space, upper case, U as T."""
    return F.translate(F.upper(F.regexp_replace(_c(seq), r"(?U)\s+", "")), "U", "T")


def ambiguity(seq: str | Column) -> Column:
    """The share of ambiguous letters; 0 for an empty sequence."""
    s = _c(seq)
    n = F.length(s)
    return F.when(n > 0, (n - F.length(F.translate(s, C.AMBIGUOUS_BASES, ""))).cast("double") / n).otherwise(F.lit(0.0))


def sequence_notes(seq: str | Column, segment: str | Column) -> Column:
    """What is odd about a cleaned sequence, as an array; lengths alone never make it invalid."""
    s, seg = _c(seq), _c(segment)
    n, amb = F.length(s), ambiguity(s)
    low, high = (literal_map({row[0]: row[i] for row in C.TABLE})[seg] for i in (4, 5))
    span = F.concat(n.cast("string"), F.lit(" bp, expected "), low.cast("string"), F.lit("-"), high.cast("string"), F.lit(")"))
    length = (
        F.when(n < low * 0.5, F.concat(F.lit("Very short ("), span))
        .when(n < low, F.concat(F.lit("Below range ("), span))
        .when(n > high * 1.1, F.concat(F.lit("Above range ("), span))
    )
    bad = F.translate(s, C.VALID_BASES, "")
    notes = F.array_compact(
        F.array(
            F.when(F.length(bad) > 0, F.concat(F.lit("Invalid characters: "), F.array_join(F.array_sort(F.array_distinct(F.split(bad, ""))), ""))),
            length,
            F.when(amb > 0.05, F.concat(F.lit("High ambiguity: "), F.format_number(amb * 100, 1), F.lit("%"))),
            F.when(amb > 0.20, F.lit("Excessive ambiguity")),
        )
    )
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.array(F.lit("Empty sequence"))).otherwise(notes)


def is_valid_sequence(seq: str | Column) -> Column:
    """Not empty, only known letters, at most a fifth of them ambiguous."""
    s = _c(seq)
    return (F.coalesce(F.length(s), F.lit(0)) > 0) & (F.length(F.translate(s, C.VALID_BASES, "")) == 0) & (ambiguity(s) <= 0.20)


def identify_segment(header: str | Column) -> Column:
    """The first segment in order with a pattern in the header, else by a segment number, else null."""
    h = _c(header)
    out = None
    for seg, p in C.SEGMENT_PATTERNS.items():
        hit = h.rlike(f"(?i){p}")
        out = F.when(hit, F.lit(seg)) if out is None else out.when(hit, F.lit(seg))
    number = F.regexp_extract(h, r"(?i)segment[_\s]*(\d)", 1)
    return F.coalesce(out, literal_map({str(i + 1): s for i, s in enumerate(C.SEGMENTS)})[F.nullif(number, F.lit(""))])


def identify_subtype(header: str | Column) -> Column:
    h = F.upper(_c(header))
    return F.when(h.contains("H1N1PDM"), "H1N1pdm09").when(h.contains("H3N2"), "H3N2").when(h.contains("H1N1"), "H1N1pdm09")


def extract_collection_date(header: str | Column) -> Column:
    """The first date with hyphens, else the first with slashes, as text with hyphens; the calendar isn't asked."""
    h = _c(header)
    dashed, slashed = (F.nullif(F.regexp_extract(h, p, 1), F.lit("")) for p in (r"(\d{4}-\d{2}-\d{2})", r"(\d{4}/\d{2}/\d{2})"))
    return F.coalesce(dashed, F.replace(slashed, F.lit("/"), F.lit("-")))


def isolate_id(header: str | Column) -> Column:
    """The header up to its first bar without segment tags; nothing left gives unknown_ and 8 digits of the md5."""
    h = _c(header)
    x = h
    for seg in C.SEGMENTS:
        x = F.regexp_replace(F.regexp_replace(x, rf"(?i)\|{seg}\b", ""), rf"(?i)_{seg}\b", "")
    x = F.regexp_replace(F.regexp_replace(x, r"(?i)\|segment[_\s]*\d", ""), r"(?i)_segment[_\s]*\d", "")
    x = F.regexp_replace(F.split(x, r"\|")[0], r"^\s+|\s+$", "")
    return F.when(x == "", F.concat(F.lit("unknown_"), F.substring(F.md5(h), 1, 8))).otherwise(x)


def subtype_number(subtype: str | Column) -> Column:
    """The number in a subtype's name; a name without one raises."""
    s = _c(subtype)
    found = F.nullif(F.regexp_extract(s, r"^H(\d+)N\d+", 1), F.lit("")).cast("int")
    return F.coalesce(literal_map(C.SUBTYPE_NUMBERS)[s], found, F.raise_error(F.concat(F.lit("no number for subtype "), F.coalesce(s, F.lit("null")))).cast("int"))


def subtype_short(subtype: str | Column) -> Column:
    s = _c(subtype)
    found = F.nullif(F.regexp_extract(s, r"^(H\d+N\d+)", 1), F.lit(""))
    return F.coalesce(literal_map(C.SUBTYPE_SHORT)[s], found, F.raise_error(F.concat(F.lit("no short name for subtype "), F.coalesce(s, F.lit("null")))).cast("string"))


def allele_subtype_number(name: str | Column) -> Column:
    """The middle number of SEG.n.m, SEG in capitals and digits; null for names of another form."""
    return F.nullif(F.regexp_extract(_c(name), r"^[A-Z0-9]+\.(\d+)\.\d+$", 1), F.lit("")).try_cast("int")


def reverse_complement(seq: str | Column) -> Column:
    pair = C.complements()
    return F.reverse(F.translate(_c(seq), "".join(pair), "".join(pair.values())))


def canonical_kmer(kmer: str | Column) -> Column:
    k = _c(kmer)
    return F.least(k, reverse_complement(k))


def kmers(seq: str | Column, k: int | Column, canonical: bool = True) -> Column:
    """The k-mers at every position in order, without those that have an N; too short a sequence has none."""
    s, kk = _c(seq), F.lit(k) if isinstance(k, int) else k
    step = 256  # a place in a string is found from its start, so long sequences are cut into overlapping chunks first
    chunks = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - kk + 1, F.lit(1)), F.lit(step)), lambda c: s.substr(c, kk + (step - 1)))
    every = F.flatten(F.transform(chunks, lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - kk + 1, F.lit(1))), lambda i: c.substr(i, kk))))
    every = F.filter(every, lambda x: ~x.contains("N"))
    every = F.transform(every, canonical_kmer) if canonical else every
    return F.when(F.length(s) >= kk, every).otherwise(F.array().cast("array<string>"))


def plain_kmers(seq: str, k: int, both_strands: bool = True) -> list[str]:
    """kmers() of one text, for letters that have no code."""
    pair = str.maketrans(C.complements())
    found = [seq[i : i + k] for i in range(len(seq) - k + 1)] if k > 0 else []
    found = [x for x in found if "N" not in x]
    return [min(x, x[::-1].translate(pair)) for x in found] if both_strands else found


def kmer_size(segment: str | Column, sketch: C.Sketch | None = None) -> Column:
    """k of a segment's signatures."""
    sketch = sketch or C.Sketch()
    return F.coalesce(literal_map(dict(sketch.k))[_c(segment)], F.lit(sketch.other_k))


def signature_header(sig: str | Column) -> Column:
    """num_hashes, seed, kmer_count and unique_kmer_count of stored bytes; null if there are fewer than 16."""
    h = F.hex(_c(sig))

    def word(i: int) -> Column:
        le = F.concat(*(F.substring(h, 8 * i + 2 * b + 1, 2) for b in (3, 2, 1, 0)))
        return F.conv(le, 16, 10).cast("long")

    return F.when(F.length(_c(sig)) >= 16, F.struct(word(0).alias("num_hashes"), word(1).alias("seed"), word(2).alias("kmer_count"), word(3).alias("unique_kmer_count")))


def is_usable(sig: str | Column) -> Column:
    """Whether stored bytes are a whole signature of something."""
    h = signature_header(sig)
    return F.coalesce((F.length(_c(sig)) == 16 + 8 * h["num_hashes"]) & (h["unique_kmer_count"] > 0) & (h["num_hashes"] > 0), F.lit(False))


def signature_lanes(sig: str | Column) -> Column:
    """The lanes of stored bytes, each as 16 hexadecimal digits in storage order: enough for equality."""
    s = _c(sig)
    n = ((F.length(s) - 16) / 8).cast("int")
    return F.when(n >= 1, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.hex(s.substr(i * 8 + 17, F.lit(8)))))


def lane_distance(a: str | Column, b: str | Column) -> Column:
    """1 - agreement; 1 where the arrays differ in length or are empty."""
    x, y = _c(a), _c(b)
    ok = (F.size(x) == F.size(y)) & (F.size(x) > 0)
    return F.when(ok, 1 - F.size(F.filter(F.zip_with(x, y, lambda p, q: p == q), lambda e: e)) / F.size(x)).otherwise(F.lit(1.0))
