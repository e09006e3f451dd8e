"""Policy: thresholds, licence rules, class maps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Licence key -> (attribution required, commercial use allowed, verdict), in rule order.
LICENCES = (
    ("mit", 0, 1, "valid"), ("apache-2.0", 0, 1, "valid"), ("bsd", 0, 1, "valid"), ("cc0", 0, 1, "valid"), ("cc-by-4.0", 1, 1, "valid"),
    ("cc-by-sa-4.0", 1, 1, "valid"), ("cc-by-nc-4.0", 1, 0, "review"), ("proprietary", 1, 0, "review"), ("unknown", 1, 0, "review"),
)

# Synonyms of the one target class.
SYNONYMS = (
    "acne", "Acne", "pimple", "pimples", "Pimples", "papule", "pustule", "nodule", "comedo", "comedone", "blackhead", "whitehead", "lesion",
    "fore", "forehead", "zit", "acne_lesion",
)

# Class names by index, the clinical action by index, and the action that was proposed by name.
CLASSES = (
    "Acne", "Blackhead", "Conglobata", "Crystanlline", "Cystic", "Flat_wart", "Folliculitis", "Keloid", "Milium", "Papular", "Purulent", "Scars",
    "Sebo-crystan-conglo", "Syringoma", "Whitehead",
)
ACTIONS = {"KEEP": (0, 1, 2, 4, 9, 10, 14), "REVIEW": (3, 6, 8, 12), "IGNORE": (7, 11), "REJECT": (5, 13)}
PROPOSED = {
    "KEEP": ("Acne", "Blackhead", "Whitehead", "Papular", "Purulent", "Cystic", "Conglobata", "Sebo-crystan-conglo", "Crystanlline"),
    "REVIEW": ("Folliculitis",), "REJECT": ("Flat_wart", "Milium", "Syringoma"), "IGNORE": ("Keloid", "Scars"),
}
CLINICAL = ("Milium", "Crystanlline", "Sebo-crystan-conglo", "Folliculitis")

STATUSES = ("accepted", "rejected", "ignored", "review", "duplicate")


@dataclass(frozen=True)
class Policy:
    """Thresholds of audit, scoring and dedup."""

    min_width: int = 640
    min_height: int = 640
    max_aspect: float = 5.0
    giant_area: float = 0.8
    tiny_area: float = 0.0001
    overlap_iou: float = 0.85
    match_iou: float = 0.40
    hamming: int = 4
    accept_score: float = 8.0
    reject_score: float = 6.0
    weights: tuple[float, float, float] = (0.40, 0.35, 0.25)
    splits: tuple[float, float] = (0.70, 0.15)


DEFAULT = Policy()


def licence(raw: Column, normalize_spaces: bool = False) -> Column:
    """struct(attribution, commercial, verdict): exact key, else the first rule whose key is within the text (DOM-01)."""
    text = F.lower(F.trim(raw))
    if normalize_spaces:
        text = F.regexp_replace(text, r"\s+", "-")
    verdict = lambda a, c, v: F.struct(F.lit(a).cast("long").alias("attribution"), F.lit(c).cast("long").alias("commercial"), F.lit(v).alias("verdict"))
    out = None
    for exact in (True, False):
        for key, a, c, v in LICENCES:
            hit = text == key if exact else text.contains(key)
            out = F.when(hit, verdict(a, c, v)) if out is None else out.when(hit, verdict(a, c, v))
    return out.otherwise(verdict(1, 0, "review"))


def class_name(index: Column, names: tuple[str, ...] = CLASSES) -> Column:
    """Name by index, else class_<i>; negatives are unknown (DOM-03, TRAP-15)."""
    table = F.array(*[F.lit(n) for n in names])
    return F.coalesce(F.when(index >= 0, F.get(table, index)), F.concat(F.lit("class_"), index.cast("string")))


def harmonised(label: Column, mapping: dict[str, str] | None = None) -> Column:
    """Target class by exact key, else by lower-case key; null where unmapped (DOM-06)."""
    mapping = mapping or dict.fromkeys(SYNONYMS, "acne")
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, label), F.try_element_at(table, F.lower(label)))


def clinical_action(index: Column) -> Column:
    """KEEP, REVIEW, IGNORE or REJECT; null for other indexes (DOM-07)."""
    out = None
    for action, indexes in ACTIONS.items():
        out = F.when(index.isin(*indexes), action) if out is None else out.when(index.isin(*indexes), action)
    return out


def missing(x: Column, default) -> Column:
    """``x or default``: zero counts as missing (TRAP-02)."""
    return F.coalesce(F.nullif(x, F.lit(0)), F.lit(default))


def valid_status(status: Column) -> Column:
    """The status, or an error if it is none of the allowed ones."""
    return F.when(status.isNull() | status.isin(*STATUSES), status).otherwise(F.raise_error(F.concat(F.lit("bad status "), status)))


def split_tag(path: Column) -> Column:
    """train, valid or test from the path, train by default (DOM-12)."""
    found = F.regexp_extract(path, "/(train|valid|test)/", 1)
    return F.when(found != "", found).otherwise("train")
