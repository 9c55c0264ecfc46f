"""Column expressions: contigs, alleles, genotypes, bins, numbers, texts, times and lists.

Every function takes and returns Columns and stays inside Spark's built-in expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- contigs


def bare_contig(chrom: Column) -> Column:
    return F.regexp_replace(chrom, "^chr", "")


def contig_class(chrom: Column) -> Column:
    """autosome, chrX, chrY, chrM or other; the prefix is optional."""
    c = bare_contig(chrom)
    return (
        F.when(c.rlike("^([1-9]|1[0-9]|2[0-2])$"), "autosome")
        .when(c == "X", "chrX")
        .when(c == "Y", "chrY")
        .when(c.isin("M", "MT"), "chrM")
        .otherwise("other")
    )


def chrom_key(chrom: Column) -> Column:
    """Sort key: numbered contigs by number, then the others by name."""
    number = bare_contig(chrom).try_cast("int")
    return F.struct(number.isNull().alias("named"), F.coalesce(number, F.lit(0)).alias("number"), F.when(number.isNull(), chrom).otherwise("").alias("name"))


# ---------------------------------------------------------------- alleles and variants


def one_kind(ref: Column, alt: Column) -> Column:
    d = F.length(alt) - F.length(ref)
    return (
        F.when((d == 0) & (F.length(ref) == 1), "SNV").when(d == 0, "MNV").when(F.abs(d) < 50, "INDEL").when(d > 0, "INS").otherwise("DEL")
    )


def variant_kind(ref: Column, alts: Column) -> Column:
    """Kind from allele lengths; alleles of several kinds make it MIXED."""
    kinds = F.array_distinct(F.transform(alts, lambda a: one_kind(ref, a)))
    return F.when(F.size(kinds) > 1, "MIXED").otherwise(F.get(kinds, 0))


def call_kind(ref: Column, alts: Column, types: Column, lengths: Column) -> Column:
    """Struct (size, kind) of the record's largest allele.

    types and lengths are arrays per allele; a missing entry falls back to the first.  A symbolic allele or a type of
    INV, DUP, BND or CPX decides over the sequence lengths.
    """

    def one(a: Column, i: Column) -> Column:
        t = F.coalesce(F.get(types, i), F.get(types, 0), F.lit(""))
        n = F.abs(F.coalesce(F.get(lengths, i), F.get(lengths, 0), F.lit(0))).cast("int")
        named = a.startswith("<")
        symbol = F.when(named, F.regexp_extract(a, "^<([^:>]*)", 1)).otherwise(t)
        kind = F.when(symbol.isin("INV", "DEL"), symbol).when(symbol.isin("INS", "DUP"), "INS").otherwise("OTHER")
        by_type = named | t.isin("INV", "DUP", "BND", "CPX")
        return F.struct(
            F.when(by_type, n).otherwise(F.abs(F.length(a) - F.length(ref))).alias("size"),
            F.when(by_type, kind).otherwise(one_kind(ref, a)).alias("kind"),
        )

    return F.array_max(F.transform(F.filter(alts, lambda a: a != ""), one))


def filter_class(filters: Column, mask: str = "ASM_UNRELIABLE") -> Column:
    """PASS, the mask's name, OTHER or BOTH from an array of filter names."""
    masked = F.array_contains(filters, mask)
    others = F.size(F.array_except(filters, F.array(F.lit("PASS"), F.lit(mask), F.lit("."), F.lit("")))) > 0
    return F.when(masked & others, "BOTH").when(masked, mask).when(others, "OTHER").otherwise("PASS")


def bin_label(x: Column, edges: list, labels: list[str]) -> Column:
    """The label of the first upper-exclusive edge above x; the last label beyond all edges."""
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(x < edge, label)
    return out.otherwise(labels[len(edges)])


#: Fixed bin sets: upper-exclusive edges and labels.
BINS = {
    "sv_size": ([50, 100, 500, 1000, 10000], ["<50", "50-99", "100-499", "500-999", "1k-9.9k", ">=10k"]),
    "af": ([0.001, 0.01, 0.05, 0.5], ["<0.1%", "0.1-1%", "1-5%", "5-50%", ">=50%"]),
    "depth": ([10, 20, 30, 40], ["<10", "10-19", "20-29", "30-39", ">=40"]),
    "graph_size": ([1000, 10000], ["50-999", "1k-9.9k", "10k+"]),
}


def binned(x: Column, name: str) -> Column:
    return bin_label(x, *BINS[name])


def admit_reason(ref: Column, alt: Column, least: int, most: int) -> Column:
    """Why a sequence allele is left out as a site, or null."""
    d = F.abs(F.length(alt) - F.length(ref))
    symbolic = alt.startswith("<") | alt.isin("*", ".") | alt.contains("[") | alt.contains("]")
    return (
        F.when(symbolic, "symbolic")
        .when((d < least) & (F.least(F.length(ref), F.length(alt)) >= least), "no_length_change")
        .when(d < least, "below_size_min")
        .when(d > most, "too_long")
    )


def allele_id(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    d = F.length(alt) - F.length(ref)
    tail = F.substring(F.sha1(F.concat(ref, F.lit(">"), alt)), 1, 8)
    return F.concat_ws("-", chrom, pos.cast("string"), F.when(d > 0, "INS").otherwise("DEL"), F.abs(d).cast("string"), tail)


# ---------------------------------------------------------------- genotypes


def gt_parts(gt: Column) -> Column:
    """Allele texts of a genotype; only the first colon field is read."""
    return F.split(F.split_part(gt, F.lit(":"), F.lit(1)), "[/|]")


def gt_alt(gt: Column, allele: str | None = None) -> Column:
    """Alternate alleles: all that are not reference or missing, or those equal to one allele."""
    return F.size(F.filter(gt_parts(gt), lambda a: (a == allele) if allele else ~a.isin("0", ".", ""))).cast("long")


def gt_called(gt: Column) -> Column:
    return F.size(F.filter(gt_parts(gt), lambda a: ~a.isin(".", ""))).cast("long")


def is_carrier(gt: Column) -> Column:
    return gt_alt(gt) > 0


def dosage(gt: Column) -> Column:
    return F.least(gt_alt(gt), F.lit(2))


def zygosity(gt: Column) -> Column:
    """missing, hom_ref, het or hom_alt."""
    parts = gt_parts(gt)
    known = F.filter(parts, lambda a: ~a.isin(".", ""))
    return (
        F.when(F.size(known) == 0, "missing")
        .when(gt_alt(gt) == 0, "hom_ref")
        .when(F.size(F.array_distinct(known)) == 1, "hom_alt")
        .otherwise("het")
    )


def order_free(gt: Column) -> Column:
    """Sorted alleles; null if one is missing."""
    parts = gt_parts(gt)
    return F.when(~F.array_contains(parts, "."), F.array_sort(parts))


def unphased(gt: Column, when: Column) -> Column:
    """Phase marks of the first colon field replaced where the condition holds."""
    cut = F.instr(gt, ":")
    head = F.when(cut > 0, F.substring(gt, F.lit(1), cut - 1)).otherwise(gt)
    rest = F.when(cut > 0, F.substring(gt, cut, F.length(gt))).otherwise("")
    return F.when(when, F.concat(F.translate(head, "|", "/"), rest)).otherwise(gt)


def missing_to_homref(gt: Column) -> Column:
    return F.when(gt.isNull() | gt.isin(".", "./.", ".|."), "0/0").otherwise(gt)


def repaired_slots(gt: Column, per_slot: Column) -> Column:
    """Values given in allele order, put back into genotype order: the stable rank of each genotype slot indexes them."""
    slots = F.transform(gt_parts(gt), lambda a, i: F.struct(a.cast("int").alias("a"), i.alias("i")))
    order = F.transform(F.array_sort(slots), lambda s: s["i"])
    ranks = F.transform(slots, lambda s: F.array_position(order, s["i"]).cast("int"))
    return F.transform(ranks, lambda r: F.get(per_slot, r - 1))


def carrier_class(n: Column, total: Column, common: float = 0.05, rare: float = 0.01) -> Column:
    """Class of a site by its carriers: >=5%, common (>=1%), rare or singleton."""
    return F.when(n >= common * total, ">=5%").when(n >= rare * total, "common").when(n > 1, "rare").otherwise("singleton")


# ---------------------------------------------------------------- numbers, texts and lists


#: Coefficients of Wichura's AS 241, from the constant term up, as (numerator, denominator) of the middle part
#: and of both tails.
QUANTILE_MIDDLE = (
    (3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125, 45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727),
    (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077, 21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610),
)
QUANTILE_TAIL = (
    (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504, 1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550, 0.148103976427480074590, 0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
QUANTILE_FAR = (
    (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230, 0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def _polynomial(coefficients: Sequence[float], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in coefficients[-2::-1]:
        out = out * x + F.lit(c)
    return out


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function (Wichura's AS 241); null outside (0, 1)."""
    q = p - 0.5
    ratio = lambda pair, x: _polynomial(pair[0], x) / _polynomial(pair[1], x)
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.when(r <= 5, ratio(QUANTILE_TAIL, r - 1.6)).otherwise(ratio(QUANTILE_FAR, r - 5))
    middle = q * ratio(QUANTILE_MIDDLE, 0.180625 - q * q)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, middle).otherwise(F.signum(q) * tail))


def log_factorial(n: Column) -> Column:
    """ln n! of whole numbers: exact below 20, by Stirling's series from there on."""
    x = n.cast("double") + 1
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    table = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(20)])
    return F.when(n < 20, F.get(table, n.cast("int"))).otherwise(series)


def number(text: Column) -> Column:
    """A finite number or null."""
    x = F.trim(text).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def numbers(text: Column, sep: str = ",") -> Column:
    """The finite numbers of a list text; others are skipped."""
    return F.filter(F.transform(F.split(text, sep), number), lambda x: x.isNotNull())


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def fixed(x: Column, digits: int) -> Column:
    """Fixed digits without trailing zeros."""
    text = F.format_string(f"%.{digits}f", x)
    return F.regexp_replace(F.regexp_replace(text, "(\\.[0-9]*?)0+$", "$1"), "\\.$", "")


def mapped(text: Column, sep: str = ";") -> Column:
    """Map of k=v entries; flags have a null value."""
    return F.str_to_map(text, F.lit(sep), F.lit("="))


def label_text(column: str, value: Column) -> Column:
    return F.concat(F.lit(f"{column}="), F.regexp_replace(F.trim(value), "[^A-Za-z0-9_.-]+", "_"))


#: Accepted spellings of a sex.
#: Spellings of a sex that sample sheets may hold.
SEXES = {"M": "XY", "MALE": "XY", "XY": "XY", "1": "XY", "F": "XX", "FEMALE": "XX", "XX": "XX", "2": "XX"}


def norm_sex(text: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in SEXES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(F.trim(text))), F.lit(""))


def is_named(trid: Column) -> Column:
    """A disease id, not an id made from a position (contig_start_end)."""
    return ~trid.rlike("^(chr)?[0-9XYM]+[_-][0-9]+[_-][0-9]+")


def seconds(text: Column) -> Column:
    """Seconds of D-HH:MM:SS, HH:MM:SS or MM:SS.mmm; null for others."""
    days = F.coalesce(F.regexp_extract(text, "^(\\d+)-", 1).try_cast("double"), F.lit(0.0))
    clock = F.regexp_replace(text, "^\\d+-", "")
    parts = F.transform(F.reverse(F.split(clock, ":")), lambda x: x.try_cast("double"))
    total_ = F.get(parts, 0) + 60 * F.coalesce(F.get(parts, 1), F.lit(0.0)) + 3600 * F.coalesce(F.get(parts, 2), F.lit(0.0)) + 86400 * days
    return F.when(text.rlike("^(\\d+-)?\\d+(:\\d+){1,2}(\\.\\d+)?$"), total_)


def megabytes(text: Column, cpus: Column | None = None) -> Column:
    """MB of texts such as 25600M, 1.5G or 4Gc (per CPU)."""
    amount = F.regexp_extract(text, "^([0-9.]+)", 1).try_cast("double")
    unit = F.upper(F.regexp_extract(text, "^[0-9.]+([KMGTkmgt]?)", 1))
    factor = F.when(unit == "K", 1 / 1024).when(unit == "G", 1024.0).when(unit == "T", 1024.0 * 1024).otherwise(1.0)
    per = F.when(text.rlike("c$") & F.lit(cpus is not None), cpus if cpus is not None else F.lit(1)).otherwise(1)
    return amount * factor * per


def gpus(tres: Column) -> Column:
    """GPUs of an attribute list (gres/gpu=2 or gres/gpu:a100=2)."""
    entries = F.map_entries(F.map_filter(F.str_to_map(tres, F.lit(","), F.lit("=")), lambda k, _: k.rlike("^gres/gpu")))
    return F.coalesce(F.array_max(F.transform(entries, lambda e: e["value"].try_cast("long"))), F.lit(0))


def human_seconds(x: Column) -> Column:
    return (
        F.when(x < 60, F.format_string("%d s", x.cast("long")))
        .when(x < 3600, F.format_string("%d min", F.round(x / 60).cast("long")))
        .otherwise(F.format_string("%d h %02d min", F.floor(x / 3600), F.floor(x % 3600 / 60)))
    )


def human_bases(x: Column) -> Column:
    return F.when(x < 1000, F.format_string("%d bp", x.cast("long"))).when(x < 1_000_000, F.concat(fixed(x / 1000, 1), F.lit(" kb"))).otherwise(F.concat(fixed(x / 1_000_000, 1), F.lit(" Mb")))


def low_high(text: Column) -> Column:
    lo, hi = (F.regexp_extract(text, "^(\\d+)-(\\d+)$", i).try_cast("long") for i in (1, 2))
    return F.struct(lo.alias("low"), hi.alias("high"))


def severity(level: Column) -> Column:
    """Rank of fail, warn, info and pass; the largest is the worst."""
    return F.when(level == "fail", 3).when(level == "warn", 2).when(level == "info", 1).otherwise(0)


# ---------------------------------------------------------------- motifs

#: IUPAC codes and the bases they stand for.
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "N": "ACGT", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG"}
#: Kinds of match, the weakest last.
MATCHES = ("exact", "rotation", "iupac")


def motif_rank(p: Column, c: Column) -> Column:
    """Place in MATCHES from 1, or null: equal, a rotation, or a rotation in which the bases at each place have one in common.

    Both may hold codes: a code of p is read as the class of all codes that share a base with it.
    """
    classes = {x: "[" + "".join(y for y in IUPAC if set(IUPAC[x]) & set(IUPAC[y])) + "]" for x in IUPAC}
    table = F.create_map(*[F.lit(v) for kv in classes.items() for v in kv])
    p, c = F.upper(p), F.upper(c)
    pattern = F.array_join(F.transform(F.filter(F.split(p, ""), lambda x: x != ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    same = F.length(p) == F.length(c)
    return F.when(p == c, 1).when(same & F.contains(F.concat(p, p), c), 2).when(same & (F.length(p) > 0) & F.rlike(F.concat(c, c), pattern), 3)


def motif_match(p: Column, c: Column) -> Column:
    """exact, rotation, iupac or null."""
    return F.get(F.array(*[F.lit(m) for m in MATCHES]), motif_rank(p, c) - 1)


def match_motifs(pathogenic: Column, catalog: Column) -> Column:
    """Of two lists of motifs: those of the catalogue that some pathogenic one matches (in the catalogue's order, once each), and the weakest kind
    of match; `partial:` before it if a pathogenic motif matches none, `none` if none does."""
    ranks = F.transform(pathogenic, lambda p: F.array_max(F.array_compact(F.transform(catalog, lambda c: motif_rank(p, c)))))
    matched = F.filter(F.array_distinct(catalog), lambda c: F.exists(pathogenic, lambda p: motif_rank(p, c).isNotNull()))
    weakest = F.get(F.array(*[F.lit(m) for m in MATCHES]), F.array_max(F.array_compact(ranks)) - 1)
    kind = F.when(F.coalesce(F.size(matched), F.lit(0)) < 1, "none").otherwise(F.concat(F.when(F.exists(ranks, lambda r: r.isNull()), "partial:").otherwise(""), weakest))
    return F.struct(matched.alias("matched"), kind.alias("motif_match"))
