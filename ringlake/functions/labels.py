"""Names: normal forms, label maps and their layers, severity words and formats."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Label layers in display order, severity words, generic words of corner names.
LAYERS = ["numbered", "official", "driver", "historical", "sponsor", "local"]
OVERLAYS = LAYERS[1:]
SCALES = {1: "Hairpin", 2: "Slow", 3: "Medium", 4: "Fast", 5: "Very fast", 6: "Kink"}
SCALE_RADII = [55.0, 95.0, 160.0, 280.0, 550.0]
GENERIC = "virage|courbe|chicane|esses|ligne droite|le|la|les|l|du|de|des|d|the|s"
#: What compatibility decomposition leaves in ASCII, for every character that it changes.
FOLDED = {c: d for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]) if (d := unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode())}
ONE = {c: d for c, d in FOLDED.items() if len(d) == 1}
#: Characters that become several, as pairs beyond ASCII text's own separators.
SEVERAL = {c: d for c, d in FOLDED.items() if len(d) > 1}


def folded(s: Column) -> Column:
    """Compatibility decomposition, then ASCII only."""
    pairs = F.str_to_map(F.lit("\x02".join(f"{c}\x01{d}" for c, d in SEVERAL.items())), F.lit("\x02"), F.lit("\x01"))
    many = F.array_join(F.transform(F.split(s, ""), lambda c: F.coalesce(F.try_element_at(pairs, c), c)), "")
    plain = F.regexp_replace(F.translate(F.when(s.rlike("[" + "".join(SEVERAL) + "]"), many).otherwise(s), "".join(ONE), "".join(ONE.values())), r"[^\x00-\x7F]", "")
    return F.when(s.rlike(r"[^\x00-\x7F]"), plain).otherwise(s)


def normalized(s: Column) -> Column:
    """Loose key: folded to ASCII, lower case, generic words and all but a-z and 0-9 removed."""
    return F.regexp_replace(F.regexp_replace(F.lower(folded(s)), rf"\b({GENERIC})\b", " "), "[^a-z0-9]+", "")


def numbered(code: Column) -> Column:
    return F.concat(F.lit("Turn "), code.cast("string"))


def resolved(labels: Column, default: str = "driver") -> Column:
    """The default layer's label if it has one, else the numbered one; never another layer."""
    return F.coalesce(F.nullif(F.try_element_at(labels, F.lit(default)), F.lit("")), F.try_element_at(labels, F.lit("numbered")))


def has_real_name(labels: Column) -> Column:
    return F.exists(F.map_keys(labels), lambda k: k != "numbered")


def layer_rank(code: Column) -> Column:
    """Sort key of label layers: the known ones in order, then others by name."""
    known = F.array_position(F.array(*[F.lit(x) for x in LAYERS]), code)
    return F.struct(F.when(known > 0, known).otherwise(len(LAYERS) + 1).alias("r"), code.alias("code"))


def titled(code: Column) -> Column:
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))


def scale_of_radius(abs_curvature: Column) -> Column:
    """Severity 1 (tight) to 6 by radius."""
    r = F.when(abs_curvature > 1e-9, 1.0 / abs_curvature)
    out = F.when(r.isNull(), F.lit(6))
    for i, most in enumerate(SCALE_RADII, 1):
        out = out.when(r < most, F.lit(i))
    return out.otherwise(F.lit(6))


def scale_word(scale: Column) -> Column:
    out = None
    for k, v in SCALES.items():
        out = F.when(scale == k, v) if out is None else out.when(scale == k, v)
    return out


def direction_word(d: Column) -> Column:
    return F.when(d.isNull(), F.lit(None).cast("string")).when(d == 1, "right").otherwise("left")


def safe_name(s: Column) -> Column:
    return F.regexp_replace(s, r"[^A-Za-z0-9._-]+", "-")


def escaped(s: Column) -> Column:
    """Text for XML and HTML."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def kilometres(m: Column) -> Column:
    return F.format_string("%.3f km", m / 1000.0)


def percent(x: Column) -> Column:
    return F.format_string("%.1f%%", x * 100.0)


def matches_all_words(query: Column, *fields: Column) -> Column:
    """Every white-space token of the query occurs in the lower-cased fields."""
    hay = F.lower(F.concat_ws(" ", *fields))
    return F.forall(F.filter(F.split(F.lower(F.trim(query)), r"\s+"), lambda w: w != ""), lambda w: F.contains(hay, w))


def merged_maps(old: Column, new: Column) -> Column:
    """Union of two maps; the new value wins where it is not null."""
    return F.map_zip_with(old, new, lambda k, a, b: F.coalesce(b, a))


def overlaid_maps(old: Column, new: Column) -> Column:
    """Like ``merged_maps``, but a key that ``new`` holds with null or '' is deleted."""
    keep = F.map_zip_with(old, new, lambda k, a, b: F.when(F.array_contains(F.map_keys(new), k), F.nullif(b, F.lit(""))).otherwise(a))
    return F.map_filter(keep, lambda k, v: v.isNotNull())


def every_nth(values: Column, step: int) -> Column:
    return F.filter(values, lambda x, i: i % step == 0)
