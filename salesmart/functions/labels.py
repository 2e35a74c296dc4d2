"""Display labels and text rules of the dashboard, menu and order pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shown by the reference's pages.
NO_HOUR_LABEL = "시간 정보 없음"
UNCATEGORISED_LABEL = "미분류"
HOUR_LABEL_FORMAT = "%02d:00–%02d:59"
# Menu kind rules, first match wins: name keywords, then category.
JUICE_KEYWORDS = ("주스", "쥬스")
CAKE_KEYWORDS = ("케이크", "케익")
BAKERY_CATEGORY = "식품"
DRINK_CATEGORY = "음료"
KINDS = ("juice", "cake", "bakery", "drink", "other")


def hour_label(hour: str) -> Column:
    """``HH:00–HH:59``; NULL hour gets the no-time label."""
    h = F.col(hour)
    return F.when(h.isNull(), F.lit(NO_HOUR_LABEL)).otherwise(F.format_string(HOUR_LABEL_FORMAT, h, h))


def category_label(category: str) -> Column:
    """NULL or empty category is shown as uncategorised."""
    c = F.col(category)
    return F.when(c.isNull() | (c == ""), F.lit(UNCATEGORISED_LABEL)).otherwise(c)


def display_name(*candidates: str) -> Column:
    """First non-empty of the candidates (the last one may be any type)."""
    cols = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in candidates]
    return F.coalesce(*cols)


def shown_average(average: str, order_count: str, digits: int = 2) -> Column:
    """Average rounded for display; NULL (shown as a dash) when there are no orders."""
    return F.when(F.col(order_count) > 0, F.round(F.col(average), digits))


def _contains_any(text: Column, words) -> Column:
    cond = F.lit(False)
    for word in words:
        cond = cond | F.coalesce(text.contains(word), F.lit(False))
    return cond


def menu_kind(
    name: str,
    category: str,
    kinds=KINDS,
    juice_keywords=JUICE_KEYWORDS,
    cake_keywords=CAKE_KEYWORDS,
    bakery_category: str = BAKERY_CATEGORY,
    drink_category: str = DRINK_CATEGORY,
) -> Column:
    """First match wins: juice words, cake words, bakery category, drink category, else."""
    juice, cake, bakery, drink, other = kinds
    n, c = F.col(name), F.col(category)
    return (
        F.when(_contains_any(n, juice_keywords), F.lit(juice))
        .when(_contains_any(n, cake_keywords), F.lit(cake))
        .when(c == bakery_category, F.lit(bakery))
        .when(c == drink_category, F.lit(drink))
        .otherwise(F.lit(other))
    )


def order_number(order_id: str) -> Column:
    """Order id zero-padded to at least four digits."""
    return F.format_string("%04d", F.col(order_id))


def search_text(order_id: str, product_name: str) -> Column:
    """Lower-cased ``"<0000 id> <id> <product name>"`` that the order search matches."""
    return F.lower(
        F.concat_ws(" ", order_number(order_id), F.col(order_id).cast("string"), F.col(product_name))
    )


def search_term(term: str) -> str:
    """Normalise a search term: trim, lower-case, drop one leading ``#``."""
    t = term.strip().lower()
    return t[1:] if t.startswith("#") else t


# Accepted order quantities are integers in 1..2147483647.
MIN_QUANTITY = 1
MAX_QUANTITY = 2147483647


def parse_quantity(text: str) -> Column:
    """Quantity text -> int, or NULL when it is not an integer literal.

    Accepted like the order form's integer parsing: surrounding whitespace, an
    optional sign, ASCII digits with single underscores between them
    (``1_000``).  Values that do not fit an int become NULL, so they are
    rejected too.
    """
    t = F.regexp_replace(F.col(text), r"^\s+|\s+$", "")
    return F.when(t.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.regexp_replace(t, "_", "").try_cast("int"))
