"""Signature rules: families of licences times the ways a text names them."""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Signature:
    """A regular expression over lower-case words, `@` before the word that must be there first.

    `tier` orders overlapping finds: a find inside another of the same or a
    lower tier is dropped.
    """

    label: str
    keyword: str
    pattern: str
    tier: int
    score: float


# Licence family, keyword, the name's words (the keyword marked), versions.
_NAMES = (
    ("apache", "apache", "@apache", ("1 0", "1 1", "2 0")),
    ("mit", "mit", "@mit", ()),
    ("bsd", "bsd", "(?:[234] clause )?@bsd", ()),
    ("gpl", "general", "gnu @general public", ("1", "2", "3")),
    ("gpl", "gpl", "(?:gnu )?@gpl", ("1", "2", "3")),
    ("lgpl", "lesser", "gnu @lesser general public", ("2", "2 1", "3")),
    ("lgpl", "lgpl", "(?:gnu )?@lgpl", ("2", "2 1", "3")),
    ("agpl", "affero", "gnu @affero general public", ("1", "3")),
    ("agpl", "agpl", "(?:gnu )?@agpl", ("1", "3")),
    ("mpl", "mozilla", "@mozilla public", ("1 0", "1 1", "2 0")),
    ("mpl", "mpl", "@mpl", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse", "@eclipse public", ("1 0", "2 0")),
    ("cddl", "cddl", "@cddl", ("1 0", "1 1")),
    ("eupl", "eupl", "@eupl", ("1 1", "1 2")),
    ("isc", "isc", "@isc", ()),
    ("zlib", "zlib", "@zlib", ()),
    ("unlicense", "unlicense", "@unlicense", ()),
    ("wtfpl", "wtfpl", "@wtfpl", ("2",)),
    ("artistic", "artistic", "@artistic", ("1 0", "2 0")),
    ("boost", "boost", "@boost software", ("1 0",)),
    ("ofl", "ofl", "(?:sil )?@ofl", ("1 0", "1 1")),
    ("cecill", "cecill", "@cecill", ("1 0", "2 0", "2 1")),
    ("gfdl", "documentation", "gnu free @documentation", ("1 1", "1 2", "1 3")),
    ("odbl", "odbl", "@odbl", ("1 0",)),
    ("python", "psf", "@psf", ("2",)),
    ("postgresql", "postgresql", "@postgresql", ()),
    ("openssl", "openssl", "@openssl", ()),
    ("cc-by", "cc", "@cc by", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "cc", "@cc by sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "cc", "@cc by nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "cc", "@cc by nc", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "cc", "@cc by nc sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "cc", "@cc by nc nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "creative", "@creative commons attribution", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc0", "cc0", "@cc0", ("1 0",)),
)
# The ways to name a licence, with `{}` for its name and version.
_WAYS = (
    (r"spdx license identifier {}(?: only| or later)?", 0, 1.0),
    (r"(?:is |are |be )?(?:dual )?licen[sc]ed (?:to you )?under (?:the )?(?:terms of (?:the )?)?{}", 1, 0.95),
    (r"(?:released|distributed|available|provided|published|shared) under (?:the )?(?:terms of (?:the )?)?{}", 1, 0.9),
    (r"{}", 2, 0.7),
)
# Phrases that any scan reports, and single signatures.
BASE = (
    Signature("cc-by", "cc", "@cc by", 3, 0.6),
    Signature("gpl", "general", "@general public license", 3, 0.6),
    Signature("reserved", "rights", "all @rights reserved", 3, 0.5),
)
_SINGLE = (
    Signature("public-domain", "domain", "(?:released|dedicated|placed) (?:in|into|to) the public @domain", 1, 0.9),
    Signature("public-domain", "domain", "public @domain dedication", 1, 0.9),
    Signature("copyright", "copyright", r"@copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?", 2, 0.5),
    Signature("proprietary", "proprietary", "@proprietary and confidential", 1, 0.8),
    Signature("no-warranty", "warranty", "without @warranty of any kind", 2, 0.4),
    Signature("bsd", "redistribution", "@redistribution and use in source and binary forms", 1, 0.9),
    Signature("mit", "permission", "@permission is hereby granted free of charge to any person", 1, 0.9),
    Signature("isc", "permission", "@permission to use copy modify and or distribute this software", 1, 0.9),
    Signature("gpl", "redistribute", "you can @redistribute it and or modify it under the terms of the gnu", 1, 0.9),
)


def signatures() -> list[Signature]:
    """All rules, base phrases first, then by tier and longest name."""
    made = list(_SINGLE)
    for family, keyword, name, versions in _NAMES:
        title = f"{name}(?: licen[sc]e)?"
        for way, tier, score in _WAYS:
            if "{}" == way and not versions and family in ("mit", "bsd", "isc", "boost", "python", "openssl", "postgresql"):
                title_here = f"{name} licen[sc]e"  # the bare word means other things, too
            else:
                title_here = title
            made.append(Signature(family, keyword, way.format(title_here), tier, score))
            for version in versions:
                mark = f"{title_here}(?: version| v)? v?{version}"
                made.append(Signature(f"{family}-{version.replace(' ', '.')}", keyword, way.format(mark), tier, score))
    made.sort(key=lambda s: (s.tier, -len(s.pattern)))
    return [*BASE, *made]


def reach(rules: list[Signature]) -> tuple[int, int]:
    """Bounds on the words before and after the keyword in any match of `rules`.

    No part of a pattern repeats, so each space in it stands for one word at
    most. Patterns that could match without bound are refused.
    """
    before = after = 0
    for signature in rules:
        if re.search(r"[*+{.]|\\[^d]|\[\^", signature.pattern):
            raise ValueError(f"no bound on the words of {signature.pattern!r}")
        head, _, tail = signature.pattern.partition("@")
        before, after = max(before, head.count(" ")), max(after, tail.count(" "))
    return before, after


#: Most words before and after the keyword that a match of the own rules can have.
BEFORE, AFTER = reach(signatures())


def anchored(signature: Signature) -> str:
    """The rule as a Java or Python expression over `words before @keyword words after`."""
    re.compile(signature.pattern)
    return rf"(?<!\S){signature.pattern}(?!\S)"
