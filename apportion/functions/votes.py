"""Column functions on votes: parsing, margins, winners, ratings, dates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, text

# Rating tiers by absolute margin in percentage points, and their colours for either party.
TIERS = ((40.0, "Annihilation", "#67000d", "#08306b"), (30.0, "Dominant", "#a50f15", "#08519c"), (20.0, "Stronghold", "#cb181d", "#3182bd"), (10.0, "Safe", "#ef3b2c", "#6baed6"), (5.5, "Likely", "#fb6a4a", "#9ecae1"), (1.0, "Lean", "#fcae91", "#c6dbef"), (0.5, "Tilt", "#fee8c8", "#e1f5fe"))
TOSSUP, TOSSUP_COLOUR = "Tossup", "#f7f7f7"
WINNER_COLOURS = {"Republican": "#cb181d", "Democratic": "#3182bd"}
SCOPES = ("congressional", "state_house", "state_senate")
CONTESTS = ("president", "us_senate", "governor", "lieutenant_governor", "attorney_general")


def parse_int(c: Column) -> Column:
    """Whole number from text with thousands commas, halves to even; 0 for blanks, dashes and anything unreadable."""
    t = F.replace(strip(c), F.lit(","), F.lit(""))
    return F.coalesce(F.bround(t.try_cast("double")).try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_float(c: Column) -> Column:
    return strip(c).try_cast("double")


def parse_votes(c: Column) -> Column:
    """Votes as a double; 0 if unreadable."""
    return F.coalesce(parse_float(c), F.lit(0.0))


def whole_votes(c: Column) -> Column:
    """Votes cut to a whole number, as county slices count them."""
    return parse_votes(c).cast("bigint")


def round_half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits) if digits else F.bround(c).cast("bigint")


def margin_pct(dem: Column, rep: Column, total: Column) -> Column:
    """Signed margin, Republican minus Democratic, as percentage of the total; null without votes."""
    return F.when(total > 0, (rep - dem).cast("double") / total.cast("double") * 100.0)


def winner(dem: Column, rep: Column) -> Column:
    return F.when(rep > dem, "Republican").when(dem > rep, "Democratic").otherwise("Tie")


def _tier(margin: Column, pick) -> Column:
    size = F.abs(margin)
    return reduce(lambda c, t: c.when(size >= t[0], pick(t)), TIERS, F.when(F.lit(False), F.lit("")))


def rating_tier(margin: Column) -> Column:
    return _tier(margin, lambda t: F.lit(t[1])).otherwise(TOSSUP)


def rating_colour(margin: Column) -> Column:
    """Colour of a signed margin; a tie takes the pale one, whichever its party."""
    return _tier(margin, lambda t: F.when(margin >= 0, t[2]).otherwise(t[3])).otherwise(TOSSUP_COLOUR)


def winner_colour(won: Column) -> Column:
    return reduce(lambda c, kv: c.when(won == kv[0], kv[1]), WINNER_COLOURS.items(), F.when(F.lit(False), F.lit(""))).otherwise(TOSSUP_COLOUR)


def pct_change(base: Column, now: Column) -> Column:
    """Percentage change to two decimals; null if the base is 0."""
    return F.when(base != 0, F.round((now - base).cast("double") / base * 100.0, 2))


def clamp(c: Column, low, high) -> Column:
    return F.greatest(F.least(c, high if isinstance(high, Column) else F.lit(high)), low if isinstance(low, Column) else F.lit(low))


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def area_weight(land: Column, water: Column) -> Column:
    """Land and water area of a block; 1 if that isn't above zero."""
    area = F.coalesce(parse_float(land), F.lit(0.0)) + F.coalesce(parse_float(water), F.lit(0.0))
    return F.when(area > 0, area).otherwise(F.lit(1.0))


def year_of_file(name: Column) -> Column:
    """Year at the head of a file name, of a date of eight digits or of four; null if there is none."""
    y = F.coalesce(F.nullif(F.regexp_extract(text(name), r"^(\d{4})\d{4}__", 1), F.lit("")), F.nullif(F.regexp_extract(text(name), r"^(\d{4})", 1), F.lit("")))
    return y.try_cast("int")


def district_order(c: Column) -> list[Column]:
    """Sort keys of districts: numbers before names, both as text."""
    return [F.when(c.rlike(r"^\d+$"), 0).otherwise(1), c]


def place_in(c: Column, order: tuple[str, ...]) -> Column:
    """Position in a fixed order; what isn't in it comes last."""
    at = F.array_position(F.array(*[F.lit(x) for x in order]), c)
    return F.when(at == 0, F.lit(len(order) + 1)).otherwise(at)
