"""DuckDB expressions equal to the text and HTML functions."""

from __future__ import annotations

# White space as Python sees it, written out: RE2's \\s is ASCII.
WS = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
      r"\x{205f}\x{3000}]")

_TAG = r"<[a-zA-Z/!?][^>]*(?:>|\z)"


def cut(text: str, pattern: str, by: str = "''") -> str:
    return f"regexp_replace({text}, '{pattern}', {by}, 'g')"


def scripts(t: str) -> str:
    return cut(t, "(?is)<script.*?>.*?</script>")


def iframes(t: str) -> str:
    return cut(t, "(?is)<iframe.*?>.*?</iframe>")


def single_quoted(t: str) -> str:
    """No lookbehind in RE2: hide escaped quotes, cut, and bring them back."""
    hidden = f"replace({t}, chr(92) || chr(39), chr(1))"
    return f"replace({cut(hidden, chr(39) * 2 + '[^' + chr(39) * 2 + ']*' + chr(39) * 2)}," \
           " chr(1), chr(92) || chr(39))"


def double_quoted(t: str) -> str:
    hidden = f"replace({t}, chr(92) || chr(34), chr(1))"
    return f"replace({cut(hidden, chr(34) + '[^' + chr(34) + ']*' + chr(34))}," \
           " chr(1), chr(92) || chr(34))"


def dollar_names(t: str) -> str:
    return cut(t, r"(?i)\$[a-z_][a-z0-9_]*")


def tags(t: str) -> str:
    return cut(t, "<[^>]+>")


def newlines(t: str) -> str:
    return cut(cut(t, r"\r\n?", "chr(10)"), r"\n{2,}", "chr(10)")


def escape(t: str) -> str:
    for raw, to in (("'&'", "&amp;"), ("'<'", "&lt;"), ("'>'", "&gt;"), ("chr(34)", "&quot;"),
                    ("chr(39)", "&#x27;")):
        t = f"replace({t}, {raw}, '{to}')"
    return t


def invisible(t: str) -> str:
    return cut(t, r"[\p{Cf}\p{Co}]")


def sanitize(t: str) -> str:
    for step in (scripts, iframes, single_quoted, double_quoted, dollar_names, tags, newlines,
                 escape, invisible):
        t = step(t)
    return t


def pruned(html: str) -> str:
    return cut(html, r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)"
                     r"|<style\b.*?(?:</style\s*>|\z)", "' '")


def decoded(t: str) -> str:
    """As HTML has it, the semicolon may be missing."""
    for entity, char in (("&lt;?", "'<'"), ("&gt;?", "'>'"), ("&quot;?", "chr(34)"),
                         ("&#39;?", "chr(39)"), ("&#x27;?", "chr(39)"), ("&nbsp;?", "chr(160)"),
                         ("&copy;?", "chr(169)"), ("&middot;?", "chr(183)"), ("&amp;?", "'&'")):
        t = cut(t, entity, char)
    return t


def collapsed(t: str) -> str:
    return f"trim({cut(t, WS + '+', chr(39) + ' ' + chr(39))})"


def visible_text(html: str) -> str:
    return collapsed(decoded(cut(pruned(html), _TAG, "' '")))


def main_text(html: str) -> str:
    body = (f"regexp_extract({pruned(html)}, "
            r"'(?is)<article\b[^<>]*>(.*?)(?:</article\s*>|\z)', 1)")
    lines = cut(cut(body, r"(?i)</?(?:p|br|h[1-6]|li|div)\b[^<>]*>", "chr(10)"), _TAG)
    spaced = cut(decoded(lines), WS + r"*\n" + WS + "*", "chr(10) || chr(10)")
    return cut(spaced, rf"^{WS}+|{WS}+$")


def extracted(html: str) -> str:
    return f"case when {main_text(html)} = '' then {visible_text(html)} else {main_text(html)} end"


def page_lang(html: str) -> str:
    return f"nullif(lower(regexp_extract({html}, '<html lang=\"([a-zA-Z]{{2}})', 1)), '')"


def netloc(url: str) -> str:
    return f"regexp_extract({url}, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)"
