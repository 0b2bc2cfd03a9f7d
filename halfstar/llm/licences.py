"""Licence scans: known sentences, then ordered rules over their identifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Sentences of public licence texts and notices, normalised, with an identifier each.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions"
    ),
    "mit-keep": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software"
    ),
    "mit-as-is": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to "
        "the warranties of merchantability fitness for a particular purpose and noninfringement"
    ),
    "mit-liable": (
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether "
        "in an action of contract tort or otherwise arising from out of or in connection with the software or the use "
        "or other dealings in the software"
    ),
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-notice-2": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-as-is": (
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied"
    ),
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version"
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose"
    ),
    "gpl-see": "see the gnu general public license for more details",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "bsd-redistribute": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution"
    ),
    "bsd-endorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission"
    ),
    "apache-copy-at": "you may obtain a copy of the license at",
    "apache-url": "http www apache org licenses license 2 0",
    "apache-url-2": "https www apache org licenses license 2 0",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v",
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "isc-as-is": (
        "the software is provided as is and the author disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness"
    ),
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc0-title": "cc0 1 0 universal",
    "cc0-notice": "licensed under cc0 1 0",
    "reserved": "all rights reserved",
}

# The GNU notices, as the splitter cuts them: after "free software" and WARRANTY, and where the
# older ones have a semicolon before the version.
_GNU = [
    ("AGPL-3.0", "gnu affero general public license", "3"),
    ("LGPL-3.0", "gnu lesser general public license", "3"),
    ("LGPL-2.1", "gnu lesser general public license", "2 1"),
    ("GPL-3.0", "gnu general public license", "3"),
    ("GPL-2.0", "gnu general public license", "2"),
]
_GNU_RULES = []
SENTENCES["gnu-warranty"] = "without even the implied warranty of merchantability or fitness for a particular purpose"
for _id, _title, _version in _GNU:
    _may, _see, _late, _whole = f"{_title[4:]}-may", f"{_title[4:]}-see", f"gnu-version-{_version}", f"{_id}-may"
    SENTENCES[_may] = f"you can redistribute it and or modify it under the terms of the {_title} as published by the free software foundation"
    SENTENCES[_late] = f"either version {_version} of the license or at your option any later version"
    SENTENCES[_whole] = f"{SENTENCES[_may]} {SENTENCES[_late]}"
    if _title != "gnu general public license":
        SENTENCES[_see] = f"see the {_title} for more details"
    else:
        _see = "gpl-see"
    for _work in ("program", "library", "software"):
        SENTENCES[f"gnu-free-{_work}"] = f"this {_work} is free software"
        SENTENCES[f"gnu-hope-{_work}"] = f"this {_work} is distributed in the hope that it will be useful but without any warranty"
        for _body in ((_whole,), (_may, _late)):
            _GNU_RULES.append((_id, "header", (f"gnu-free-{_work}", *_body, f"gnu-hope-{_work}", "gnu-warranty", _see)))
            _GNU_RULES.append((_id, "notice", (f"gnu-free-{_work}", *_body)))
    _GNU_RULES += [(_id, "notice", (_whole,)), (_id, "notice", (_may, _late))]

# Sentences with free words; ``*`` stands for 1 to 12 words, a holder or an organisation.
TEMPLATES = {
    "bsd-endorse": [
        "neither the name of * nor the names of * may be used to endorse or promote products derived from this software without specific prior written permission",
        "neither the names of * nor the names of * may be used to endorse or promote products derived from this software without specific prior written permission",
        "neither * nor the names of * may be used to endorse or promote products derived from this software without specific prior written permission",
        "the name of * may not be used to endorse or promote products derived from this software without specific prior written permission",
        "the names of * may not be used to endorse or promote products derived from this software without specific prior written permission",
        # behind a name with a full stop, such as "Inc."
        "nor the names of * may be used to endorse or promote products derived from this software without specific prior written permission",
        "nor the name of * may be used to endorse or promote products derived from this software without specific prior written permission",
        "may not be used to endorse or promote products derived from this software without specific prior written permission",
    ],
}
# Names that prose gives to licences, normalised.
TITLES = {
    "MIT": ["mit license", "mit licence", "expat license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache licence 2 0"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2", "gnu gpl v2", "gplv2"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3", "gnu gpl v3", "gplv3"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "lgplv2 1"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lesser general public license v3", "lgplv3"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu affero general public license v3", "agplv3"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license v 2 0", "eclipse public license 2 0"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0"],
    "ISC": ["isc license", "isc licence"],
    "CC-BY-4.0": ["creative commons attribution 4 0 international license", "creative commons attribution 4 0 license"],
    "CC-BY-SA-4.0": ["creative commons attribution sharealike 4 0 international license", "creative commons attribution share alike 4 0 international license"],
    "CC-BY-NC-4.0": ["creative commons attribution noncommercial 4 0 international license"],
}
# Identifiers of SPDX lines, normalised; a suffix -only or -or-later is left out.
SPDX = {
    "mit": "MIT", "apache 2 0": "Apache-2.0", "bsd 2 clause": "BSD-2-Clause", "bsd 3 clause": "BSD-3-Clause", "gpl 2 0": "GPL-2.0",
    "gpl 3 0": "GPL-3.0", "lgpl 2 1": "LGPL-2.1", "lgpl 3 0": "LGPL-3.0", "agpl 3 0": "AGPL-3.0", "mpl 2 0": "MPL-2.0", "epl 2 0": "EPL-2.0",
    "bsl 1 0": "BSL-1.0", "isc": "ISC", "unlicense": "Unlicense", "cc0 1 0": "CC0-1.0", "cc by 4 0": "CC-BY-4.0", "cc by sa 4 0": "CC-BY-SA-4.0",
}
SENTENCES["spdx-mark"] = _MARK = "spdx license identifier"
SENTENCES |= {f"spdx-{text}{end}": f"{_MARK} {text}{end}" for text in SPDX for end in ("", " only", " or later")}
SENTENCES |= {f"under-{licence}": f"licensed under the {titles[0]}" for licence, titles in TITLES.items()}

# Licences as sequences of identifiers; the first rule that matches at a place wins.
RULES = [
    ("MIT", "text", ("mit-grant", "mit-keep", "mit-as-is", "mit-liable")),
    ("MIT", "grant", ("mit-grant",)),
    ("MIT", "notice", ("mit-notice",)),
    ("MIT", "notice", ("mit-notice-2",)),
    ("Apache-2.0", "header", ("apache-notice-2", "apache-comply", "apache-copy", "apache-as-is", "apache-see")),
    *(
        ("Apache-2.0", "header", ("apache-notice-2", "apache-comply", "apache-copy-at", url, "apache-as-is", "apache-see"))
        for url in ("apache-url", "apache-url-2")
    ),
    ("Apache-2.0", "notice", ("apache-notice",)),
    ("Apache-2.0", "notice", ("apache-notice-2",)),
    *_GNU_RULES,
    ("GPL-3.0", "header", ("gpl-free", "gpl-hope", "gpl-see")),
    ("GPL-3.0", "notice", ("gpl-free",)),
    ("GPL-3.0", "notice", ("gpl3-notice",)),
    ("CC-BY-NC-4.0", "notice", ("cc-by-nc-notice",)),
    ("CC-BY-SA-4.0", "notice", ("cc-by-sa-notice",)),
    ("CC-BY-4.0", "notice", ("cc-by-notice",)),
    ("MPL-2.0", "notice", ("mpl-form",)),
    ("ISC", "text", ("isc-grant", "isc-as-is")),
    ("ISC", "grant", ("isc-grant",)),
    ("Unlicense", "text", ("unlicense",)),
    ("CC0-1.0", "text", ("cc0-title",)),
    ("CC0-1.0", "notice", ("cc0-notice",)),
    ("BSD-3-Clause", "text", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", "text", ("bsd-redistribute", "bsd-source", "bsd-binary")),
    *((licence, "reference", (f"under-{licence}",)) for licence in TITLES),
    *((SPDX[text], "spdx", ("spdx-mark", f"spdx-{text}{end}")) for text in SPDX for end in ("", " only", " or later")),
    ("proprietary", "reserved", ("reserved",)),
]

#: Every known sentence holds one of these; texts without them are passed over.
TRIGGERS = ("licen", "gplv", "copyright", "warrant", "redistribut", "rights reserved", "free software", "public domain", "cc0")
#: Foreign sentences allowed between two sentences of one rule.
GAP = 2

_WORD = re.compile(r"[^\W_]+")
# a line without words, such as a bare comment sign, is a blank one
_END = re.compile(r"[.!?;:]+(?=\s|$)|\n[^\w\n]*\n")
_LINE_END = re.compile(r"[.!?;:]+(?=\s|$)|\n")
# the splitter cuts an SPDX line behind the colon of its mark; what is under a title is told by the title
_KNOWN = {text.removeprefix(f"{_MARK} "): name for name, text in SENTENCES.items() if not name.startswith("under-")}
_LONGEST = max(t.count(" ") for t in SENTENCES.values()) + 2
_LIST_MARK = re.compile(r"^(?:\d{1,2}|[a-z])\s+")


def _normal(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


_FREE = [(name, re.compile(t.replace("*", r"\w+(?: \w+){0,11}"))) for name, texts in TEMPLATES.items() for t in texts]
_UNDER = re.compile(
    r"\b(?:licen[sc]ed|released|distributed|available|published|provided|covered|shared) (?:to you )?(?:under|by) (?:the )?(?:terms of )?(?:the |an? )?("
    + "|".join(sorted((t for texts in TITLES.values() for t in texts), key=len, reverse=True))
    + r")\b"
)
_TITLE_OF = {text: licence for licence, texts in TITLES.items() for text in texts}
#: Words of a sentence that names its licence in passing, at most.
PROSE_WORDS = 60


def _name(sentence: str) -> str | None:
    """Identifier of a normalised sentence: as it stands, without a list mark, with free words, or by a licence's title in prose."""
    bare = _LIST_MARK.sub("", sentence)
    if name := _KNOWN.get(sentence) or _KNOWN.get(bare):
        return name
    if "endorse" in bare:
        for name, pattern in _FREE:
            if pattern.fullmatch(bare):
                return name
    if (" under " in sentence or " by " in sentence) and sentence.count(" ") < PROSE_WORDS and (found := _UNDER.search(sentence)):
        return f"under-{_TITLE_OF[found[1]]}"
    return None


def _segments(text: str, end: re.Pattern) -> Iterator[tuple[int, int]]:
    at = 0
    for stop in end.finditer(text):
        yield at, stop.end()
        at = stop.end()
    yield at, len(text)


def _after_open_line(part: str) -> tuple[int, str] | None:
    """(place, identifier) of a known sentence that ends ``part`` and begins with one of its lines."""
    cut = part.rfind("\n")
    while cut >= 0:
        sentence = _normal(part[cut:])
        if sentence.count(" ") >= _LONGEST:
            return None
        if name := _name(sentence):
            return cut, name
        cut = part.rfind("\n", 0, cut)
    return None


def identifiers(text: str) -> list[tuple[int, str | None]]:
    """The sentence sequence as (place, identifier or None).

    A licence text may be wrapped over lines, and a notice may stand on a line
    of its own or follow a line without a full stop. So sentences are cut with
    and without line ends, and a reading that knows a sentence is preferred.
    """
    found: dict[int, str | None] = {}
    for at, stop in _segments(text, _LINE_END):
        if name := _name(_normal(text[at:stop])):
            found[_WORD.search(text, at).start()] = name
    for at, stop in _segments(text, _END):
        sentence = _normal(text[at:stop])
        if not sentence:
            continue
        start = _WORD.search(text, at).start()
        found[start] = found.get(start) or _name(sentence)
        if not found[start] and (late := _after_open_line(text[at:stop])):
            found[_WORD.search(text, at + late[0]).start()] = late[1]
    return sorted(found.items())


def matches(text: str) -> list[tuple[str, str, int, int]]:
    """(licence, rule, place, sentences) in order of place; a sentence serves one match."""
    low = text.lower()
    if not any(t in low for t in TRIGGERS):
        if not any(t.split()[-1] in low for t in TRIGGERS) or not any(t in _normal(text) for t in TRIGGERS):
            return []  # not over a line end either
    sequence = identifiers(text)
    known = [(n, at, name) for n, (at, name) in enumerate(sequence) if name]
    out, i = [], 0
    while i < len(known):
        for licence, rule, names in RULES:
            run = known[i : i + len(names)]
            close = all(b[0] - a[0] <= GAP + 1 for a, b in zip(run, run[1:]))
            if close and tuple(x[2] for x in run) == names:
                out.append((licence, rule, run[0][1], len(names)))
                i += len(names)
                break
        else:
            i += 1  # a sentence that no rule opens with
    return out


def licence_scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, licence, rule, place, sentences)``: the licences named in every whole text.

    ``place`` is the code point where the match begins. A sentence is known by
    its normalised words alone; a rule needs its sentences in order, with at
    most two foreign sentences between neighbours; where several rules fit, the
    first of the list wins. Every match of a text is reported. The tables are
    fixed and ship with the task; nothing is shuffled.

    Null and empty texts give no row; null and repeated ids are kept; an empty
    table gives none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, *m) for i, t in enumerate(batch.column("text").to_pylist()) if t for m in matches(t)
            ]
            if rows:
                at, licence, rule, place, count = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(at)),
                        pa.array(licence),
                        pa.array(rule),
                        pa.array(place, pa.int64()),
                        pa.array(count, pa.int64()),
                    ],
                    ["doc_id", "licence", "rule", "place", "sentences"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, licence string, rule string, place long, sentences long"
    )
