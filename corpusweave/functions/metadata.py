"""Sample metadata as built-in expressions: environments, token slots, numbers, ages, phenotypes, ids and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The environment main classes and the token domains of a sample text.
MAINS = ("animal", "soil", "aquatic", "plant")
SITES = ("gut", "skin", "oral", "urogenital", "lung", "gastric", "nose", "bone")
SEXES = ("female", "male")
AGES = ("infant", "baby", "toddler", "adult", "elderly")
SMOKING = ("smoker",)
HEALTH = ("healthy", "disease", "infection", "inflammatory bowel disease", "dermatitis", "cystic fibrosis", "cholera", "malaria", "pneumonia", "typhoid fever", "tuberculosis", "patient")
#: Age bins as (label, start above, end at most).
AGE_BINS = (("3-18", 3, 18), ("18-35", 18, 35), ("35-45", 35, 45), ("45-60", 45, 60), ("60-75", 60, 75))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def env_tags(text: Column) -> Column:
    """Array of ``struct<main, sub>`` of a text of bar-separated tags; a bare main has an empty sub; '' and NULL have none."""
    tags = F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, "[|]"))
    return F.transform(tags, lambda t: F.struct(F.substring_index(t, ";", 1).alias("main"), F.when(F.instr(t, F.lit(";")) > 0, F.substring(t, F.instr(t, F.lit(";")) + 1, F.length(t))).otherwise(F.lit("")).alias("sub")))


def env_flag(tags: Column, main: str) -> Column:
    return F.exists(tags, lambda t: t["main"] == main)


def env_subs(tags: Column, main: str) -> Column:
    """The subs of a main joined by bars in source order; NULL if the main is absent, '' if its only sub is empty."""
    own = F.filter(tags, lambda t: t["main"] == main)
    return F.when(F.size(own) > 0, F.array_join(F.transform(own, lambda t: t["sub"]), "|"))


def human_class(tags: Column) -> Column:
    """``Human``, ``HumanMix`` (with other animals beside) or NULL."""
    subs = F.transform(F.filter(tags, lambda t: t["main"] == "animal"), lambda t: t["sub"])
    return F.when(F.array_contains(subs, "human"), F.when(F.exists(subs, lambda s: ~s.isin("human", "")), F.lit("HumanMix")).otherwise(F.lit("Human")))


def env_rebuilt_equal(tags: Column, text: Column) -> Column:
    """Round trip: the tags written again hold the same set as the text's own tags with a bare main as ``main;``."""
    pieces = F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, "[|]"))
    full = F.transform(pieces, lambda t: F.when(F.instr(t, F.lit(";")) > 0, t).otherwise(F.concat(t, F.lit(";"))))
    again = F.transform(tags, lambda t: F.concat(t["main"], F.lit(";"), t["sub"]))
    return F.array_sort(F.array_distinct(again)) == F.array_sort(F.array_distinct(full))


def slot_tokens(text: Column) -> Column:
    """Non-empty pieces of a semicolon-separated text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), ";"), lambda t: t != "")


def pick_one(tokens: Column, allowed: Sequence[str]) -> Column:
    return F.get(F.filter(tokens, lambda t: t.isin(*allowed)), F.lit(0))


def pick_all(tokens: Column, allowed: Sequence[str]) -> Column:
    own = F.filter(tokens, lambda t: t.isin(*allowed))
    return F.when(F.size(own) > 0, F.array_join(own, ";"))


def has_any(tokens: Column, allowed: Sequence[str], value: str) -> Column:
    return F.when(F.exists(tokens, lambda t: t.isin(*allowed)), F.lit(value))


def most_matches(tokens: Column, allowed: Sequence[str]) -> Column:
    """How many tokens fall in a slot that may hold one."""
    return F.size(F.filter(tokens, lambda t: t.isin(*allowed)))


def split_once(c: Column, sep: str, at: int) -> Column:
    """Part 0 or 1 of a text cut at the first separator; NULL if there is no such part."""
    return F.get(F.split(c, f"[{sep}]", 2), F.lit(at))


_FLOAT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def lenient_float(c: Column) -> Column:
    """A double, or NULL for anything that is not a plain decimal number."""
    t = F.trim(c)
    return F.when(t.rlike(_FLOAT), t.try_cast("double"))


def strict_float(c: Column) -> Column:
    """A double, NULL for ''; anything else raises."""
    return blank_to_null(c).cast("double")


def geo_pair(c: Column) -> Column:
    """``struct<lat, lon>`` of exactly two numbers between blanks; both NULL otherwise."""
    parts = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", ""), r"\s+")
    a, b = lenient_float(F.get(parts, F.lit(0))), lenient_float(F.get(parts, F.lit(1)))
    ok = (F.size(parts) == 2) & a.isNotNull() & b.isNotNull()
    return F.struct(F.when(ok, a).alias("lat"), F.when(ok, b).alias("lon"))


def strip_strings(df: DataFrame) -> DataFrame:
    """All string columns without blanks of any kind at their ends."""
    return df.select(*(F.regexp_replace(c, r"^\s+|\s+$", "").alias(c) if t == "string" else F.col(c) for c, t in df.dtypes))


def replace_exact(c: Column, pairs: Mapping[str, str]) -> Column:
    """Whole values replaced, others kept: escape repairs and category renames."""
    e = c
    for old, new in pairs.items():
        e = F.when(c == old, F.lit(new)).otherwise(e)
    return e


def age_group(start: Column, end: Column) -> Column:
    """The bin that holds the whole interval; an interval across bins, or with a missing end, has none."""
    e = F.when((start >= 0) & (end <= 3), F.lit("0-3"))
    for label, above, most in AGE_BINS:
        e = e.when((start > above) & (end <= most), F.lit(label))
    return F.when(end.isNotNull(), e.when(start > 75, F.lit("75+")))


def case_or_control(phenotype: Column) -> Column:
    return F.when(phenotype.isin("Control", "Health"), F.lit("control")).when(phenotype.isNotNull(), F.lit("case"))


def is_healthy(phenotype: Column) -> Column:
    """True for health, unknown for controls, false for everything else that is known."""
    return F.when(phenotype == "Health", F.lit(True)).when(phenotype == "Control", F.lit(None).cast("boolean")).when(phenotype.isNotNull(), F.lit(False))


def first_prefix(c: Column, labels: Sequence[tuple[str, str]], other: str | None = None) -> Column:
    """The label of the first prefix that a text starts with."""
    e = F.lit(other).cast("string")
    for prefix, label in reversed(labels):
        e = F.when(c.startswith(prefix), F.lit(label)).otherwise(e)
    return e


def surrogate_id(prefix: str, row_number: Column, width: int = 7) -> Column:
    """``prefix`` and a zero-padded number that starts at 0."""
    return F.concat(F.lit(prefix), F.lpad((row_number - 1).cast("string"), width, "0"))


def missing_as_na(c: Column) -> Column:
    """NULL and the texts nan, None, <NA> as ``NA``."""
    return F.when(c.isNull() | c.isin("nan", "None", "<NA>"), F.lit("NA")).otherwise(c)


def env_bucket(human: Column, animal: Column, soil: Column, aquatic: Column, plant: Column) -> Column:
    """One bucket per sample, by priority human, animal, soil, aquatic, plant."""
    f = lambda c: F.coalesce(c, F.lit(False))
    return F.when(f(human), "Human").when(f(animal), "Animal_other").when(f(soil), "Soil").when(f(aquatic), "Aquatic").when(f(plant), "Plant").otherwise("Unknown")


def collapse_label(c: Column, keep: str, other: str) -> Column:
    """What follows a prefix, or one constant for all other labels."""
    return F.when(c.startswith(keep), F.substring(c, F.lit(len(keep) + 1), F.length(c))).otherwise(F.lit(other))


def quoted_label(c: Column) -> Column:
    """A tree label, quoted where it holds a character of the tree notation."""
    return F.when(c.rlike(r"[\s()\[\]{}:;,'\"]"), F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))).otherwise(c)


def pair_list(text: Column) -> Column:
    """Map of ``k: v; k: v``; the last of repeated keys counts."""
    entries = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda p: F.struct(F.trim(F.substring_index(p, ":", 1)).alias("k"), F.trim(F.substring(p, F.instr(p, F.lit(":")) + 1, F.length(p))).alias("v"), (F.instr(p, F.lit(":")) > 0).alias("ok"))), lambda e: e["ok"])
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["k"] == k), -1)["v"]))


def gated(value: Column, gate: Column, wanted: str, missing: str = "-") -> Column:
    """The value only where the gate has the wanted value; the missing mark is NULL."""
    return F.when(gate == wanted, F.nullif(F.coalesce(value, F.lit(missing)), F.lit(missing)))


def project_feature(project: Column, feature: Column) -> Column:
    """The name of a feature within its project, ``project__feature``; NULL where either is."""
    return F.concat(project.cast("string"), F.lit("__"), feature.cast("string"))
