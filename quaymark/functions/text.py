"""Text cleaning and identifier formatting, all as native column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(c: Column) -> Column:
    """Trim and collapse inner whitespace."""
    return F.regexp_replace(F.trim(c), r"\s+", " ")


def title(c: Column) -> Column:
    return F.initcap(F.trim(c))


def canonical(c: Column) -> Column:
    """Trimmed lower case, the form that synonym lists are written in."""
    return F.lower(F.trim(c))


def capitals(c: Column) -> Column:
    return F.upper(F.trim(c))


def digits(c: Column, after: str = "") -> Column:
    """First run of digits (directly after a prefix); null where there is none."""
    found = F.regexp_extract(c, f"{after}([0-9]+)", 1)
    return F.when(found != "", found)


def pad(c: Column, width: int, fill: str = "0") -> Column:
    """Left-pad to a width. Longer text is kept whole, where plain lpad would cut it."""
    text = c.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, fill)).otherwise(text)


def padded_id(c: Column, prefix: str, width: int, after: str = "") -> Column:
    """'cart15' -> 'CA000015'. Null where the input holds no digits."""
    return F.concat(F.lit(prefix), pad(digits(c, after), width))


def sequence_id(number: Column, prefix: str, width: int) -> Column:
    return F.concat(F.lit(prefix), pad(number, width))


def account_id(user_id: Column) -> Column:
    """The one mapping from a raw user id (KH...) to an account id."""
    return padded_id(user_id, "ACC", 8, after="KH")


def numbered_name(c: Column, word: str, after: str, width: int = 0) -> Column:
    """'product7' -> 'Product 07'."""
    number = digits(c, after)
    return F.concat(F.lit(f"{word} "), pad(number, width) if width else number)


def campaign_name(c: Column) -> Column:
    """'salename1' -> 'Program Sale 01'."""
    number = digits(c, "salename").try_cast("int")
    return F.when(number.isNotNull(), F.concat(F.lit("Program Sale "), F.format_string("%02d", number)))


def phone(c: Column, width: int = 0, missing: str | None = None) -> Column:
    """Leading zero, optional padding, optional text for a missing number."""
    text = pad(c, width) if width else c.cast("string")
    number = F.concat(F.lit("0"), text)
    return number if missing is None else F.when(c.isNotNull(), number).otherwise(F.lit(missing))


def _accent_table() -> tuple[str, str]:
    """Lower-case Latin letters with marks and their bare letter, by canonical decomposition.

    The barred d does not decompose, so it is added by hand.
    """
    marked, bare = ["đ"], ["d"]
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        parts = unicodedata.normalize("NFD", letter)
        plain = "".join(p for p in parts if not unicodedata.combining(p))
        if letter == letter.lower() and len(plain) == 1 and plain != letter:
            marked.append(letter)
            bare.append(plain)
    return "".join(marked), "".join(bare)


MARKED, BARE = _accent_table()


def strip_diacritics(c: Column) -> Column:
    """Lower case without accents, for composed and decomposed input alike."""
    return F.regexp_replace(F.translate(F.lower(c), MARKED, BARE), r"\p{Mn}", "")


def first_word(c: Column) -> Column:
    return F.split(c, " ").getItem(0)


def last_word(c: Column) -> Column:
    return F.element_at(F.split(c, " "), -1)


def without_last_word(c: Column) -> Column:
    return F.regexp_replace(c, r"\s*\S+$", "")


def customer_email(first: Column, last: Column, suffix: Column) -> Column:
    surname = strip_diacritics(F.regexp_replace(last, " ", ""))
    return F.concat(strip_diacritics(first), F.lit("."), surname, pad(suffix, 3), F.lit("@gmail.com"))


def company_email(first: Column, last: Column, employee_id: Column, domain: str) -> Column:
    number = F.regexp_replace(employee_id, "EP", "")
    return F.concat(strip_diacritics(first), strip_diacritics(first_word(last)), number, F.lit(f"@{domain}"))


def account_name(first: Column, account: Column) -> Column:
    return F.concat(strip_diacritics(first), F.lit("_"), F.substring(account, 4, 8))


def photo_link(base: str, product: Column, version: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), product, F.lit("/"), version, F.lit(".jpg"))


def identity(email: Column, number: Column) -> Column:
    """Who a customer is: e-mail and phone, with a word for a missing part."""
    return F.concat_ws(
        "_", F.coalesce(email, F.lit("unknown")), F.coalesce(number.cast("string"), F.lit("unknown"))
    )
