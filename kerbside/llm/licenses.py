"""License detection by ordered signature rules.

A text becomes its lower-case words, joined by one space. Each rule is a regular expression
over that, with the words it cannot do without; the words of a text are looked up once, and
only rules whose words are all there are searched. Every match is a detection: an interval
of words, with the rule's label, priority and weight. Detections overlap, since a name lies
within a notice and a short name within a long one. One whose interval lies within that of
a detection of higher priority is suppressed; of the same priority, within that of a longer
one or, if equal, of an earlier rule. That order is total and containment is transitive, so
what is suppressed does not depend on the order of work. Base rules are counted everywhere
and never suppressed.

Rules are forms times licenses, and signatures of their texts. Documents stay in their
tasks, and nothing is shuffled.

Defined cases: a null text is empty, and has no words and no detections. Rows that repeat
an id are rows of their own; a null id is carried. Columns other than doc_id and text are
not read. Texts of any length are searched whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import pieces, small_batches, spaced

DETECTION = "struct<first:bigint,words:bigint,label:string,rule:string,priority:int,weight:double>"
_FOUND = f"doc_id bigint, n_words bigint, base array<{DETECTION}>, detections array<{DETECTION}>"

# Priorities, highest first.
TAG, CLAUSE, NOTICE, LINK, NAME, HINT = 5, 4, 3, 2, 1, 0
LEVELS = 6


@dataclass(frozen=True)
class Rule:
    """A signature: what it matches, the words it needs, and what a match says.

    Every match holds a word of each group of ``needs``; the first group leads to the rule.
    """

    name: str
    label: str
    pattern: str
    needs: tuple[frozenset[str], ...]
    priority: int
    weight: float
    base: bool = False

    @property
    def regex(self) -> re.Pattern:
        return _compiled(self.pattern)


@lru_cache(maxsize=None)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])")


# The phrases that a document is told by, and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label, the words a name cannot do without, and the names, as they read without punctuation.
LICENSES = [
    ("mit", "mit", r"mit"),
    ("mit-0", "mit|mit0", r"mit (?:no attribution|0)|mit0"),
    ("x11", "x11", r"x11|mit x11"),
    ("apache-1.0", "apache 1|v1", r"apache(?: software)?(?: license)?(?: version)? v?1 0"),
    ("apache-1.1", "apache 1|v1", r"apache(?: software)?(?: license)?(?: version)? v?1 1"),
    ("apache-2", "apache|asl 2|v2", r"apache(?: software)?(?: license)?(?: version)? v?2(?: 0)?|asl 2(?: 0)?"),
    ("bsd", "bsd", r"bsd(?: style)?"),
    ("bsd-0-clause", "bsd|0bsd", r"0bsd|bsd (?:0|zero) clause|(?:0|zero) clause bsd"),
    ("bsd-1-clause", "bsd", r"bsd (?:1|one) clause|(?:1|one) clause bsd"),
    ("bsd-2-clause", "bsd", r"(?:simplified|freebsd) bsd|bsd (?:2|two) clause|(?:2|two) clause bsd"),
    ("bsd-3-clause", "bsd", r"(?:new|revised|modified) bsd|bsd (?:3|three) clause|(?:3|three) clause bsd"),
    ("bsd-4-clause", "bsd", r"(?:original|old) bsd|bsd (?:4|four) clause|(?:4|four) clause bsd"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("libpng", "libpng", r"libpng(?: 2 0)?"),
    ("bsl-1.0", "boost", r"boost(?: software)?(?: license)?(?: version)?(?: 1 0)?"),
    ("busl-1.1", "business source", r"business source(?: license)?(?: version)?(?: 1 1)?"),
    ("mpl-1.1", "mozilla public", r"mozilla public(?: license)?(?: version)? v?1 1"),
    ("mpl-2", "mozilla public", r"mozilla public(?: license)?(?: version)? v?2(?: 0)?"),
    ("epl-1.0", "eclipse public", r"eclipse public(?: license)?(?: version)? v?1(?: 0)?"),
    ("epl-2.0", "eclipse public", r"eclipse public(?: license)?(?: version)? v?2(?: 0)?"),
    ("edl-1.0", "eclipse distribution", r"eclipse distribution(?: license)?(?: version)?(?: v?1 0)?"),
    ("cddl-1.0", "common development", r"common development and distribution(?: license)?(?: version)?(?: 1 0)?"),
    ("cpl-1.0", "common public", r"common public(?: license)?(?: version)?(?: 1 0)?"),
    ("cpal-1.0", "common public attribution", r"common public attribution(?: license)?(?: version)?(?: 1 0)?"),
    ("eupl-1.1", "european union", r"european union public(?: licen[cs]e)?(?: version)? v?1 1"),
    ("eupl-1.2", "european union", r"european union public(?: licen[cs]e)?(?: version)? v?1 2"),
    ("osl-3.0", "open software", r"open software(?: license)?(?: version)? v?3(?: 0)?"),
    ("afl-3.0", "academic free", r"academic free(?: license)?(?: version)? v?3(?: 0)?"),
    ("artistic-1.0", "artistic", r"artistic(?: license)?(?: version)? v?1(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic(?: license)?(?: version)? v?2(?: 0)?"),
    ("artistic", "artistic", r"artistic"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?"),
    ("python-2.0", "python", r"python(?: software foundation)?(?: license)?(?: version)?(?: v?2(?: 0)?)?"),
    ("php-3.01", "php", r"php(?: license)?(?: version)?(?: v?3 01)?"),
    ("ruby", "ruby", r"ruby"),
    ("perl", "perl", r"perl(?: 5)?|same terms as perl(?: itself)?"),
    ("openssl", "openssl", r"openssl"),
    ("postgresql", "postgresql", r"postgresql"),
    ("unicode", "unicode", r"unicode(?: inc)?(?: data files and software)?"),
    ("ofl-1.1", "open font", r"(?:sil )?open font(?: license)?(?: version)?(?: 1 1)?"),
    ("w3c", "w3c", r"w3c(?: software(?: notice)?(?: and)?)?"),
    ("wtfpl", "want to", r"do what the f[a-z]* you want to public"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("json", "json", r"json"),
    ("ms-pl", "microsoft public", r"microsoft public(?: license)?"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal(?: license)?"),
    ("sspl-1", "server side", r"server side public(?: license)?(?: version)?(?: v?1)?"),
    ("elastic-2.0", "elastic", r"elastic(?: license)?(?: version)?(?: v?2(?: 0)?)"),
    ("commons-clause", "commons clause", r"commons clause(?: license condition)?"),
    ("polyform-nc", "polyform", r"polyform noncommercial(?: license)?(?: 1 0 0)?"),
    ("openrail-m", "openrail", r"(?:creativeml |bigscience )?openrail(?: m)?"),
    ("llama", "llama community", r"llama(?: [0-9]+(?: [0-9]+)?)? community"),
    ("odbl-1.0", "open database", r"open database(?: license)?(?: version)?(?: v?1 0)?"),
    ("odc-by-1.0", "commons attribution", r"open data commons attribution(?: license)?(?: v?1 0)?"),
    ("pddl-1.0", "dedication", r"public domain dedication and(?: license)?(?: v?1 0)?"),
    ("cdla-permissive", "community permissive", r"community data(?: license)?(?: agreement)? permissive(?: [12](?: 0)?)?"),
    ("cdla-sharing", "community sharing", r"community data(?: license)?(?: agreement)? sharing(?: 1 0)?"),
    ("ogl-uk", "open government", r"open government(?: licen[cs]e)?(?: v?[123](?: 0)?)?"),
    ("etalab-2.0", "etalab", r"etalab(?: open)?(?: licen[cs]e)?(?: 2 0)?"),
]

#: Names that mean nothing else need no form around them.
PLAIN = (
    "apache-2 bsd-2-clause bsd-3-clause busl-1.1 mpl-1.1 mpl-2 epl-1.0 epl-2.0 eupl-1.2 sspl-1 openrail-m polyform-nc "
    "commons-clause odbl-1.0 odc-by-1.0 pddl-1.0 cdla-permissive wtfpl ofl-1.1"
).split()

# The families whose members follow from a version or from parts of the name.
_GNU = {
    "gpl": ("general", r"(?:gnu )?general public", ("gpl",), ("1", "2", "3")),
    "lgpl": ("lesser", r"(?:gnu )?lesser general public", ("lgpl",), ("2", "2.1", "3")),
    "agpl": ("affero", r"(?:gnu )?affero general public", ("agpl",), ("1", "3")),
    "fdl": ("documentation", r"(?:gnu )?free documentation", ("gfdl", "fdl"), ("1.1", "1.2", "1.3")),
}
_CC_PARTS = ("by", "by nc", "by nd", "by sa", "by nc nd", "by nc sa")
_CC_NAMES = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s", "sa": "share ?alike"}
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def _gnu() -> Iterator[tuple[str, str, str]]:
    later = r"(?: or(?: at your option)?(?: any)? later(?: version)?| and later| plus)"
    for family, (word, long, shorts, versions) in _GNU.items():
        publisher = r"(?: licen[cs]e)?(?: as published by the free software foundation)?(?: either)?"
        yield family, word, long
        for version in versions:
            number = version.replace(".", " ") + ("" if "." in version else "(?: 0)?")
            names = [(word, rf"{long}{publisher}(?: version)? v?{number}(?: of the license)?")]
            names += [(short, rf"(?:gnu )?{short}(?: version)? v?{number}") for short in shorts]
            for needs, name in names:
                yield f"{family}-{version}", needs, name
                yield f"{family}-{version}-or-later", needs, name + later


def _creative_commons() -> Iterator[tuple[str, str, str]]:
    for parts in _CC_PARTS:
        long = "creative commons " + " ".join(_CC_NAMES[part] for part in parts.split())
        label = "cc-" + parts.replace(" ", "-")
        yield label, "creative commons", long
        for version in _CC_VERSIONS:
            number = version.replace(".", " ")
            yield f"{label}-{version}", "cc " + parts, rf"cc {parts}(?: version)? v?{number}"
            kind = r"(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?(?: version)?"
            yield f"{label}-{version}", "creative commons", rf"{long}{kind} v?{number}"
        if label not in BASE_PHRASES.values():
            yield label, "cc " + parts, rf"cc {parts}"
    yield "cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"
    yield "cc0-1.0", "creative commons zero", r"creative commons zero(?: v?1 0)?(?: universal)?"
    yield "cc-pdm", "mark domain", r"public domain mark(?: 1 0)?"


# How a name is mentioned: form, further needed word, what stands around the name, priority, weight.
FORMS = [
    ("tag", "spdx", r"spdx licen[cs]e identifier {}", TAG, 1.0),
    ("field", "license|licence", r"licen[cs]e {}", NAME, 0.6),
    ("licensed", "licensed", r"(?:is |are |be )?(?:dual )?licensed under(?: the)?(?: terms of)?(?: the)? {}(?: public)?(?: licen[cs]es?)?", NOTICE, 0.95),
    ("released", "under", r"(?:released|distributed|available|published|provided|covered|made available)(?: and [a-z]+)? under(?: the)?(?: terms of)?(?: the)? {}(?: public)?(?: licen[cs]es?)?", NOTICE, 0.95),
    ("terms", "terms", r"(?:under|subject to|according to) the terms(?: and conditions)? of(?: the)? {}(?: public)?(?: licen[cs]es?)?", NOTICE, 0.9),
    ("copyleft", "redistribute", r"redistribute it and or modify it under the terms of(?: the)? {}(?: public)?(?: licen[cs]es?)?", NOTICE, 1.0),
    ("name", "license|licenses|licence|licences", r"(?:the )?{}(?: public)? licen[cs]es?", NAME, 0.7),
]

# Signatures of license texts: label, needed words, pattern, priority, weight.
SIGNATURES = [
    ("mit", "permission hereby granted free charge", r"permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files)?", CLAUSE, 1.0),
    ("mit", "merchantability noninfringement", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", CLAUSE, 0.8),
    ("mit", "substantial portions", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", CLAUSE, 0.9),
    ("isc", "permission copy modify distribute fee", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", CLAUSE, 1.0),
    ("bsd", "redistribution source binary permitted", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", CLAUSE, 0.9),
    ("bsd-3-clause", "neither contributors endorse", r"neither the name of [^ ]+(?: [^ ]+){0,8} nor the names of its contributors may be used to endorse or promote products", CLAUSE, 1.0),
    ("bsd-4-clause", "advertising acknowledgement", r"all advertising materials mentioning features or use of this software must display the following acknowledgement", CLAUSE, 1.0),
    ("apache-2", "apache january 2004", r"apache license version 2 0 january 2004", CLAUSE, 1.0),
    ("apache-2", "compliance obtain copy", r"you may not use this file except in compliance with the license you may obtain a copy of the license at", CLAUSE, 0.9),
    ("apache-2", "limitations governing permissions", r"see the license for the specific language governing permissions and limitations under the license", CLAUSE, 0.8),
    ("gpl", "redistribute program free", r"this program is free software you can redistribute it and or modify it", CLAUSE, 0.9),
    ("lgpl", "redistribute library free", r"this library is free software you can redistribute it and or modify it", CLAUSE, 0.9),
    ("gpl", "everyone verbatim permitted", r"everyone is permitted to copy and distribute verbatim copies of this license document", CLAUSE, 0.8),
    ("mpl-2", "mozilla source subject", r"this source code form is subject to the terms of the mozilla public license v 2 0", CLAUSE, 1.0),
    ("zlib", "altered misrepresented", r"altered source versions must be plainly marked as such and must not be misrepresented", CLAUSE, 1.0),
    ("bsl-1.0", "boost permission organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy", CLAUSE, 1.0),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", CLAUSE, 1.0),
    ("wtfpl", "want", r"you just do what the f[a-z]* you want to", CLAUSE, 1.0),
    ("cc0-1.0", "waived copyright", r"(?:has|have) waived all copyright and related(?: or| and) neighboring rights", CLAUSE, 1.0),
    ("public-domain", "domain public", r"(?:is|are|placed|released|dedicated)(?: hereby)?(?: placed| dedicated| released)?(?: in| to| into) the public domain", NOTICE, 0.9),
    ("public-domain", "domain public", r"public domain", HINT, 0.3),
    ("all-rights-reserved", "reserved rights", r"all rights reserved", NOTICE, 0.9),
    ("proprietary", "proprietary confidential", r"(?:proprietary and confidential|confidential and proprietary)(?: information)?", NOTICE, 0.9),
    ("proprietary", "unauthorized copying", r"unauthorized copying(?: of this file)?(?: via any medium)?(?: is strictly prohibited)?", NOTICE, 0.9),
    ("proprietary", "reproduced permission", r"may not be reproduced(?: or [a-z]+){0,3}(?: in any form)?(?: or by any means)? without(?: the)?(?: prior)?(?: express)?(?: written)? permission", NOTICE, 0.9),
    ("proprietary", "user end agreement license", r"end user license agreement", NOTICE, 0.8),
    ("non-commercial", "noncommercial|commercial|personal use only", r"(?:for )?(?:non ?commercial|personal)(?: and [a-z]+)? use only", NOTICE, 0.8),
    ("non-commercial", "commercial prohibited", r"commercial use(?: of this [a-z]+)? is(?: strictly)? prohibited", NOTICE, 0.8),
    ("research-only", "academic|research|nonprofit|profit for only", r"for (?:academic|research|non ?profit)(?: and [a-z]+)?(?: research)?(?: purposes?| use) only", NOTICE, 0.8),
    ("no-ai-training", "train models|model", r"may not be used to train(?: [a-z]+){0,4} models?", NOTICE, 0.8),
    ("copyright", "copyright", r"copyright(?: c)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*", HINT, 0.4),
    ("open-source", "source open license|licence", r"(?:an )?open source licen[cs]e", HINT, 0.4),
    ("creative-commons", "commons creative", r"creative commons", HINT, 0.5),
]

# Addresses, as they read without punctuation: label, needed words, pattern.
LINKS = [
    ("mit", "opensource", r"opensource org licenses mit(?: license)?(?: php)?"),
    ("isc", "opensource", r"opensource org licenses isc"),
    ("bsd-2-clause", "opensource", r"opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "opensource", r"opensource org licenses bsd 3 clause"),
    ("apache-2", "apache", r"(?:www )?apache org licenses license 2 0(?: txt| html)?"),
    ("bsl-1.0", "boost", r"(?:www )?boost org license 1 0(?: txt)?"),
    ("mpl-2", "mozilla mpl", r"(?:www )?mozilla org mpl 2 0|mozilla org en us mpl 2 0"),
    ("epl-2.0", "eclipse", r"(?:www )?eclipse org legal epl 2 0"),
    ("gpl", "gnu", r"(?:www )?gnu org (?:licenses gpl|copyleft gpl)(?: [23] 0)?(?: html| txt)?"),
    ("lgpl", "gnu", r"(?:www )?gnu org (?:licenses lgpl|copyleft lesser)(?: [23] [01])?(?: html| txt)?"),
    ("agpl", "gnu", r"(?:www )?gnu org licenses agpl(?: 3 0)?(?: html| txt)?"),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("cc-pdm", "creativecommons", r"creativecommons org publicdomain mark 1 0"),
    ("unlicense", "unlicense", r"unlicense org"),
]


def _groups(*needs: str) -> tuple[frozenset[str], ...]:
    """Groups stand apart by spaces, the words of a group by bars."""
    return tuple(frozenset(group.split("|")) for part in needs for group in part.split())


def _rules() -> Iterator[Rule]:
    for phrase, label in BASE_PHRASES.items():
        rarest_first = " ".join(sorted(phrase.split(), key=lambda word: word in ("under", "the", "license", "version", "2", "by")))
        yield Rule(f"base:{label}", label, phrase, _groups(rarest_first), NOTICE, 0.95, base=True)
    for label, needs, pattern, priority, weight in SIGNATURES:
        yield Rule(f"text:{label}", label, pattern, _groups(needs), priority, weight)
    for label, needs, pattern in LINKS:
        yield Rule(f"link:{label}", label, pattern, _groups(needs), LINK, 0.9)
    for parts in _CC_PARTS:
        label, pattern = "cc-" + parts.replace(" ", "-"), rf"creativecommons org licenses {parts}(?: [1-4] [05])?"
        yield Rule(f"link:{label}", label, pattern, _groups("creativecommons"), LINK, 0.9)
    families = [*_gnu(), *_creative_commons()]
    for label, needs, name in (*LICENSES, *families):
        for form, further, around, priority, weight in FORMS:
            yield Rule(f"{form}:{label}", label, around.format(f"(?:{name})"), _groups(needs, further), priority, weight)
    for label, needs, name in (*(x for x in LICENSES if x[0] in PLAIN), *(x for x in families if x[0] not in _GNU)):
        yield Rule(f"plain:{label}", label, name, _groups(needs), NAME, 0.6)


RULES: tuple[Rule, ...] = tuple(_rules())


class Scanner:
    """Rules by the words that lead to them."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = rules
        self.words = {word.encode() for rule in rules for group in rule.needs for word in group}
        self.leads: dict[bytes, list[int]] = {}
        self.needs = [[{word.encode() for word in group} for group in rule.needs] for rule in rules]
        for number, needs in enumerate(self.needs):
            for word in needs[0]:
                self.leads.setdefault(word, []).append(number)

    def gated(self, text: bytes) -> list[int]:
        """The rules whose words a text has, in their order."""
        found: set[bytes] = set()
        for piece in pieces(text):
            found |= self.words.intersection(piece.split(b" "))
        led = {number for word in found & self.leads.keys() for number in self.leads[word]}
        return sorted(n for n in led if all(found & group for group in self.needs[n][1:]))

    def matches(self, text: bytes, numbers: Sequence[int]) -> list[tuple[int, int, int]]:
        """First word, number of words and rule of every match of the given rules, in no order."""
        found = []
        for number in numbers:
            spans = [match.span() for match in self.rules[number].regex.finditer(text)]
            word = place = 0
            for start, end in spans:  # by place, so that spaces are counted once
                word += text.count(b" ", place, start)
                place = start
                found.append((word, text.count(b" ", start, end) + 1, number))
        return found

    def standing(self, found: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """What no other detection suppresses, by first word, length and rule; base rules always stand."""
        order = sorted(found, key=lambda d: (d[0], -d[1], -self.rules[d[2]].priority, d[2]))
        furthest, kept = [-1] * LEVELS, []
        for first, words, number in order:
            rule = self.rules[number]
            if rule.base or max(furthest[rule.priority :]) < first + words:
                kept.append((first, words, number))
            furthest[rule.priority] = max(furthest[rule.priority], first + words)
        return sorted(kept)


def words_of(text: bytes | None) -> bytes:
    """The lower-case words of a text, joined by one space."""
    return re.sub(rb"  +", b" ", spaced(text)).strip(b" ")


@lru_cache(maxsize=4)
def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def scan(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, n_words, base (every place of a base phrase) and detections (all that stand, base ones too)."""
    rules = tuple(rules)
    kind = pa.list_(
        pa.struct(
            [("first", pa.int64()), ("words", pa.int64()), ("label", pa.string()), ("rule", pa.string()),
             ("priority", pa.int32()), ("weight", pa.float64())]
        )
    )

    def described(found: Sequence[tuple[int, int, int]]) -> list[tuple]:
        return [
            {"first": first, "words": words, "label": r.label, "rule": r.name, "priority": r.priority, "weight": r.weight}
            for first, words, r in ((first, words, rules[number]) for first, words, number in found)
        ]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(rules)
        for batch in batches:
            counts, base, stand = [], [], []
            for value in batch.column("text").cast(pa.binary()):
                text = words_of(value.as_py())
                found = scanner.matches(text, scanner.gated(text))
                counts.append(text.count(b" ") + 1 if text else 0)
                base.append(described(sorted(d for d in found if rules[d[2]].base)))
                stand.append(described(scanner.standing(found)))
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(base, kind), pa.array(stand, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "base", "detections"])

    small_batches(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(search, _FOUND)


def labels_of(*detections: Column) -> Column:
    """The distinct labels of detections, sorted and joined by commas."""
    labels = F.concat(*[F.transform(found, lambda d: d["label"]) for found in detections])
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def score_of(detections: Column) -> Column:
    """The greatest weight of the detections; 0 if there are none."""
    return F.coalesce(F.array_max(F.transform(detections, lambda d: d["weight"])), F.lit(0.0))
