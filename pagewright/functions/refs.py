"""Column functions that rewrite attachment references in markdown."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions.text import col, let


def _quoted(path: Column) -> Column:
    """A path as a literal part of a regular expression."""
    return F.concat(F.lit(r"\Q"), F.replace(path, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _verbatim(text: Column) -> Column:
    """A text as a literal replacement."""
    return F.regexp_replace(text, r"([\\$])", r"\\$1")


def templated(path) -> Column:
    return F.concat(F.lit("{"), col(path), F.lit("}"))


def alt_text(name) -> Column:
    """File name without its extension."""
    return F.regexp_replace(col(name), r"(?s)\.[^.]*\z", "")


def _image(alt: Column, url: Column) -> Column:
    return F.concat(F.lit("!["), alt, F.lit("]("), url, F.lit(")"))


def replace_templated_image(content, path, url, name) -> Column:
    """``![alt]({path})`` → ``![alt](url)``; an empty alt becomes the file name."""
    target, url = templated(path), col(url)
    out = F.replace(col(content), _image(F.lit(""), target), _image(alt_text(name), url))
    pattern = F.concat(F.lit(r"!\[([^\]]+)\]\("), _quoted(target), F.lit(r"\)"))
    return F.regexp_replace(out, pattern, _image(F.lit("$1"), _verbatim(url)))


def replace_templated_doc(content, path, url, name=None) -> Column:
    return F.replace(col(content), templated(path), col(url))


def replace_image(content, path, url, name) -> Column:
    """Direct image references: with alt, with a size title, empty alt, bare ``(path)``."""
    content, path, url, alt = col(content), col(path), col(url), alt_text(name)
    quoted = _quoted(path)
    size = F.concat(quoted, F.lit(r'(?U)\s*"\s*=(\d+)x(\d+)'))
    titled = F.concat(quoted, F.lit(r'(?U)\s*"[^"]*"\)'))

    def size_part(i):
        return F.call_function("regexp_extract", content, size, F.lit(i))

    attr = F.when(F.rlike(content, size),
                  F.concat(F.lit(' " ='), size_part(1), F.lit("x"), size_part(2), F.lit('"'))).otherwise("")

    def rewrite(target):
        kept_alt = _image(F.lit("$1"), _verbatim(target))
        named = _image(alt, target)
        out = F.replace(content, _image(F.lit(""), path), named)
        out = F.regexp_replace(
            out, F.concat(F.lit(r"!\[([^\]]+)\]\("), quoted, F.lit(r"\)")), kept_alt)
        out = F.regexp_replace(out, F.concat(F.lit(r"!\[\]\("), titled), _verbatim(named))
        out = F.regexp_replace(out, F.concat(F.lit(r"!\[([^\]]+)\]\("), titled), kept_alt)
        return F.replace(out, F.concat(F.lit("("), path, F.lit(")")), named)

    return let(F.concat(url, attr), rewrite)


def replace_doc(content, path, url, name) -> Column:
    """Direct file references: link target, parenthesised path, bare path."""
    path, url = col(path), col(url)
    out = F.replace(col(content), F.concat(F.lit("]("), path, F.lit(")")),
                    F.concat(F.lit("]("), url, F.lit(")")))
    out = F.replace(out, F.concat(F.lit("("), path, F.lit(")")),
                    F.concat(F.lit("("), url, F.lit(")")))
    return F.replace(out, path, F.concat(F.lit("["), col(name), F.lit("]("), url, F.lit(")")))


def apply_detail(content, path, url, name, image) -> Column:
    """All rules of one uploaded attachment, the templated form first."""
    content, image = col(content), col(image)
    as_image = let(replace_templated_image(content, path, url, name),
                   lambda c: replace_image(c, path, url, name))
    as_doc = replace_doc(replace_templated_doc(content, path, url), path, url, name)
    return F.when(image, as_image).otherwise(as_doc)


def apply_details(content, details) -> Column:
    """Fold over (ord, path, url, name, image) structs in their order."""
    return F.aggregate(F.array_sort(col(details)), col(content), lambda c, d: apply_detail(
        c, d["path"], d["url"], d["name"], d["image"]))
