"""Title, body text and lead image of a stored page, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Named entities; the ampersand comes last so that it cannot start a new one.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"),
)

# Every alternative starts after a common "<", so that a position without one fails at once.
DROPPED_BLOCKS = (
    r"(?is)<(?:!--.*?-->"
    r"|script\b[^>]*>.*?</script>"
    r"|style\b[^>]*>.*?</style>"
    r"|nav\b[^>]*>.*?</nav>)"
)
BLOCK_ENDS = r"(?i)<(?:/(?:p|div|h[1-6]|li|tr|blockquote)\s*>|br\s*/?>|p\b[^>]*>)"


def unescape(text: Column) -> Column:
    """Text with numeric and the common named character references decoded."""
    pieces = F.split(text, r"(?=&#[0-9]{1,7};)")

    def decode(piece: Column) -> Column:
        digits = F.regexp_extract(piece, r"^&#([0-9]{1,7});", 1)
        point = digits.try_cast("int")
        rest = F.regexp_replace(piece, r"^&#[0-9]{1,7};", "")
        valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        return F.when(valid, F.concat(char, rest)).otherwise(piece)

    decoded = F.when(F.contains(text, F.lit("&#")), F.array_join(F.transform(pieces, decode), "")).otherwise(text)
    for name, char in ENTITIES:
        decoded = F.replace(decoded, F.lit(name), F.lit(char))
    return decoded


def raw_title(html: Column) -> Column:
    """Content of the title element without tags; empty if absent."""
    return F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"<[^>]*>", "")


def one_line(text: Column) -> Column:
    """Text with every run of white space as one blank, trimmed."""
    return F.trim(F.regexp_replace(text, r"\s{2,}|[^\S ]", " "))


def without_blocks(html: Column) -> Column:
    """Page without comments, scripts, styles and navigation."""
    return F.regexp_replace(html, DROPPED_BLOCKS, " ")


def main_part(html: Column) -> Column:
    """Content of the article element if there is one, else of the body, else nothing."""
    article = F.regexp_extract(html, r"(?is)<article\b[^>]*>(.*)</article>", 1)
    whole = F.regexp_extract(html, r"(?is)<body\b[^>]*>(.*)</body>", 1)
    return F.when(article != "", article).otherwise(whole)


def block_lines(html: Column) -> Column:
    """Text without tags, one block per line."""
    return F.regexp_replace(F.regexp_replace(html, BLOCK_ENDS, "\n"), r"<[^>]*>", "")


def tidy_lines(text: Column) -> Column:
    """Lines without surplus blanks and without empty lines."""
    flat = F.trim(F.regexp_replace(text, r"[ \t\r\f]{2,}|[\t\r\f]", " "))
    return F.btrim(F.regexp_replace(flat, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def preview_tag(html: Column) -> Column:
    """The tag that names the preview image; empty if absent."""
    return F.regexp_extract(html, r"(?is)<meta\b[^>]*property\s*=\s*[\"']og:image[\"'][^>]*>", 0)


def preview_address(tag: Column) -> Column:
    """Address in a preview tag."""
    return F.regexp_extract(tag, r"(?is)content\s*=\s*[\"']([^\"']*)[\"']", 1)


def first_image(html: Column) -> Column:
    """Address of the first image; empty if there is none."""
    return F.regexp_extract(html, r"(?is)<img\b[^>]*?\bsrc\s*=\s*[\"']([^\"']*)[\"']", 1)
