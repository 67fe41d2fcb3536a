"""Text of free labels, paths and file names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxloom import vocabulary as V


def normalize_text(text: Column) -> Column:
    """Lower case, every run of non-alphanumeric characters one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _plain(phrase: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in phrase.lower()).split())


def canonical_label(
    raw: Column, aliases: dict[str, list[str]] | None = None, priority: list[str] | None = None
) -> Column:
    """First class, in priority order, with an alias contained in the normalised text; else null.

    Containment is on characters, not words, so "bed" is found in "bedside".
    Classes missing from the priority list are tried after it.
    """
    aliases = V.ALIASES if aliases is None else aliases
    order = [n for n in (priority or V.ALIAS_PRIORITY) if n in aliases]
    order += [n for n in aliases if n not in order]

    def first(text: Column) -> Column:
        found = None
        for name in order:
            phrases = [p for p in map(_plain, aliases[name]) if p]
            if not phrases:
                continue
            # an alias that contains a shorter one of its class adds nothing
            short = [p for p in phrases if not any(q != p and q in p for q in phrases)]
            hit = F.lit(False)
            for phrase in dict.fromkeys(short):
                hit = hit | text.contains(phrase)
            found = F.when(hit, name) if found is None else found.when(hit, name)
        return F.lit(None).cast("string") if found is None else found

    # as an element of an array the text is normalised once per row; else it would be once per alias
    return F.transform(F.array(normalize_text(raw)), first)[0]


def suffix(path: Column) -> Column:
    """Lower-case suffix without the dot; empty when there is none."""
    return F.lower(F.regexp_extract(path, r"[^/.][^/]*?\.([^./]+)$", 1))


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def leaf_folder(path: Column) -> Column:
    """Name of the folder that holds the file; ``_root`` for a file without one."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.try_element_at(parts, F.lit(-2))).otherwise("_root")


def top_folder(path: Column) -> Column:
    """First folder of a relative path; ``_root`` for a file without one."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, parts[0]).otherwise("_root")


def parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def forward_slashes(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def with_suffix(path: Column, new: str) -> Column:
    """The path with its last suffix replaced."""
    return F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", ""), F.lit(new))


def labels_dir(images_dir: Column) -> Column:
    """Where the label files of an images folder are expected."""
    folder = F.regexp_replace(images_dir, r"/+$", "")
    return (
        F.when(folder.rlike(r"(?i)(^|/)images/[^/]+$"),
               F.regexp_replace(folder, r"(?i)(^|/)images/([^/]+)$", "$1labels/$2"))
        .when(folder.rlike(r"(?i)(^|/)images$"), F.regexp_replace(folder, r"(?i)(^|/)images$", "$1labels"))
        .otherwise(F.concat(folder, F.lit("_labels")))
    )


def export_stem(source_class: Column, path: Column, sha1: Column) -> Column:
    """class__stem__first-12-of-sha1: equal names from two classes stay apart."""
    return F.concat_ws("__", source_class, stem(path), F.substring(sha1, 1, 12))


def slug(query: Column) -> Column:
    return F.replace(F.lower(F.trim(query)), F.lit(" "), F.lit("-"))
