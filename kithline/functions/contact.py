"""Phone and e-mail cleaning as column expressions, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.strip sees it, as a list and as a pattern, and the e-mail shape.
SPACES = " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a" \
         "\u2028\u2029\u202f\u205f\u3000"
SPACE = r"\s\x1c-\x1f"
EMAIL_SHAPE = rf"(?U)\A[^@{SPACE}]+@[^@{SPACE}]+\.[^@{SPACE}]+\z"

# National numbers behind country code 971, by the public numbering plan: mobile, landline,
# 800 freephone, and the 400/600/700/900 service ranges; and numbers behind the assigned country codes of others.
NATIONAL_NUMBER = r"5[0-9]{8}|[2-4679][0-9]{7}|800[0-9]{2,9}|[4679]00[0-9]{6}"
FOREIGN_NUMBER = (
    r"(?!971)(?=[0-9]{8,15}\z)(?:1[2-9][0-9]{9}|7[3-9][0-9]{9}"
    r"|(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])[0-9]+"
    r"|(?:2(?:1[1-8]|[2-4][0-9]|5[0-8]|6[0-9]|9[0-9])|3[578][0-9]|42[0137]|5[09][0-9]|6[78][0-9]|69[0-2]|85[02356]|88[06]"
    r"|96[0-8]|97[02-79]|99[2-68])[0-9]+)"
)
# What may stand around the digits of a number, apart from leading words.
LOCAL_SHAPE = rf"\A(?:(?:\+|00)?971)?0?({NATIONAL_NUMBER})\z"
EXTENSION = r"[\s,;]*(?:extension|extn|ext|x|#)[.:\s]*[0-9]{1,7}\s*\z"
SEPARATORS = r"[\s().\-/]+"
# Arabic-Indic, extended Arabic-Indic and full-width digits.
OTHER_DIGITS = "٠١٢٣٤٥٦٧٨٩" "۰۱۲۳۴۵۶۷۸۹" "０１２３４５６７８９"


def _match(value: Column, pattern: str) -> Column:
    """``value`` when all of it has the anchored ``pattern``, else NULL; evaluates ``value`` once."""
    return F.nullif(F.regexp_extract(value, pattern, 0), F.lit(""))


def normalize_email(email: Column) -> Column:
    """Trimmed lower-case address, NULL when it does not look like one."""
    return _match(F.lower(F.trim(email, F.lit(SPACES))), EMAIL_SHAPE)


def email_domain(email: Column) -> Column:
    return F.split_part(email, F.lit("@"), F.lit(2))


def normalize_phone(raw: Column, strict: bool = False) -> Column:
    """E.164 text or NULL.

    Strict mode knows the four plain local shapes only. The general mode also takes free text: leading words,
    separators, ``(0)``, an extension, other digit scripts, landlines, and foreign numbers behind ``+``/``00``.
    """
    if strict:
        return (
            F.when(raw.rlike(r"\A\+971[0-9]{9}\z"), raw)
            .when(raw.rlike(r"\A00971[0-9]{9}\z"), F.concat(F.lit("+"), F.substring(raw, 3, 12)))
            .when(raw.rlike(r"\A0[0-9]{9}\z"), F.concat(F.lit("+971"), F.substring(raw, 2, 9)))
            .when(raw.rlike(r"\A971[0-9]{9}\z"), F.concat(F.lit("+"), raw))
        )
    # The plain shapes need one match; only what fails it goes through the cleaning.
    plain = F.concat(F.lit("+971"), F.nullif(F.regexp_extract(raw, LOCAL_SHAPE, 1), F.lit("")))
    ascii_digits = F.translate(raw, OTHER_DIGITS + "＋", "0123456789" * 3 + "+")
    # Whatever is left besides digits and a leading plus makes the last match fail.
    bare = F.regexp_replace(ascii_digits, rf"(?i)(?U)^[^0-9+]+|[\s.\-/]*\(0\)|{EXTENSION}|{SEPARATORS}", "")
    local = F.regexp_replace(bare, LOCAL_SHAPE, "+971$1")
    return F.coalesce(
        plain,
        _match(F.regexp_replace(local, r"^00", "+"), rf"\A\+(?:971(?:{NATIONAL_NUMBER})|{FOREIGN_NUMBER})\z"),
    )
