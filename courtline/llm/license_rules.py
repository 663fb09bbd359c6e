"""The ordered signature rules of operator 12.

A rule is a regular expression over a text's words, which are in lower case and
one space apart, with a label, a priority (smaller goes first), a weight and a
keyword, a string that every match contains.  Four kinds are written out by
hand below: whole sentences of the licenses, addresses, SPDX identifiers and
names.  Names are told in several ways (granted, with a version, with "or
later", bare), each of which is a rule of its own.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    kind: str
    priority: int
    weight: float
    keyword: str
    pattern: re.Pattern


#: kind -> (priority, weight)
KINDS = {
    "sentence": (0, 0.99), "spdx": (1, 0.99), "address": (2, 0.9), "grant": (3, 0.95),
    "later": (4, 0.9), "version": (5, 0.85), "name": (6, 0.6),
}

#: label | keyword | name | versions, or - | words of the SPDX identifier, or - if another line has them
NAMES = """
gpl | general public | gnu general public licen[cs]e | 1.0 2.0 3.0 | gpl
gpl | gpl | (?:gnu )?gpl(?: licen[cs]e)? | 1.0 2.0 3.0 | -
lgpl | general public | gnu (?:lesser|library) general public licen[cs]e | 2.0 2.1 3.0 | lgpl
lgpl | lgpl | (?:gnu )?lgpl(?: licen[cs]e)? | 2.0 2.1 3.0 | -
agpl | affero | (?:gnu )?affero general public licen[cs]e | 1.0 3.0 | agpl
agpl | agpl | (?:gnu )?agpl(?: licen[cs]e)? | 1.0 3.0 | -
gfdl | free documentation | (?:gnu )?free documentation licen[cs]e | 1.1 1.2 1.3 | gfdl
apache | apache licen | apache licen[cs]e | 1.0 1.1 2.0 | apache
apache | apache software licen | apache software licen[cs]e | 1.0 1.1 2.0 | -
mit | mit licen | mit licen[cs]e | - | mit
mit | expat licen | expat licen[cs]e | - | -
mit | x11 licen | (?:mit )?x11 licen[cs]e | - | x11
bsd-0-clause | bsd | (?:0|zero) clause bsd(?: licen[cs]e)? | - | 0bsd
bsd-2-clause | bsd | (?:(?:2|two) clause |simplified |free)bsd(?: licen[cs]e)? | - | bsd 2 clause
bsd-3-clause | bsd | (?:(?:3|three) clause |new |revised |modified )bsd(?: licen[cs]e)? | - | bsd 3 clause
bsd-4-clause | bsd | (?:(?:4|four) clause |original )bsd(?: licen[cs]e)? | - | bsd 4 clause
bsd | bsd | bsd(?: style)? licen[cs]e | - | -
isc | isc licen | isc licen[cs]e | - | isc
zlib | zlib | zlib(?: libpng)? licen[cs]e | - | zlib
libpng | libpng licen | libpng licen[cs]e | 2.0 | libpng
mpl | mozilla public | mozilla public licen[cs]e | 1.0 1.1 2.0 | mpl
epl | eclipse public | eclipse public licen[cs]e | 1.0 2.0 | epl
edl | eclipse distribution | eclipse distribution licen[cs]e | 1.0 | -
cddl | common development and distribution | common development and distribution licen[cs]e | 1.0 1.1 | cddl
cpl | common public | common public licen[cs]e | 1.0 | cpl
cpal | common public attribution | common public attribution licen[cs]e | 1.0 | cpal
eupl | european union public | european union public licen[cs]e | 1.0 1.1 1.2 | eupl
eupl | eupl | eupl(?: licen[cs]e)? | 1.0 1.1 1.2 | -
artistic | artistic licen | (?:perl )?artistic licen[cs]e | 1.0 2.0 | artistic
bsl | boost software | boost software licen[cs]e | 1.0 | bsl
afl | academic free | academic free licen[cs]e | 1.1 1.2 2.0 2.1 3.0 | afl
osl | open software licen | open software licen[cs]e | 1.0 2.0 2.1 3.0 | osl
ofl | open font | (?:sil )?open font licen[cs]e | 1.0 1.1 | ofl
python | python software foundation licen | python software foundation licen[cs]e | 2.0 | psf
python | python licen | python licen[cs]e | 2.0 | python
php | php licen | php licen[cs]e | 3.0 3.01 | php
ruby | ruby licen | ruby licen[cs]e | - | ruby
unlicense | unlicense | unlicense | - | unlicense
wtfpl | wtfpl | wtfpl | - | wtfpl
cc0 | cc0 | cc0 | 1.0 | cc0
cc0 | cc zero | cc zero | 1.0 | -
public-domain-mark | public domain mark | public domain mark | 1.0 | -
pddl | public domain dedication and licen | (?:open data commons )?public domain dedication and licen[cs]e | 1.0 | pddl
odbl | open database | (?:open data commons )?open database licen[cs]e | 1.0 | odbl
odc-by | open data commons attribution | open data commons attribution licen[cs]e | 1.0 | odc by
ogl-uk | open government | open government licen[cs]e | 1.0 2.0 3.0 | ogl uk
cdla-permissive | community data licen | community data licen[cs]e agreement permissive | 1.0 2.0 | cdla permissive
cdla-sharing | community data licen | community data licen[cs]e agreement sharing | 1.0 | cdla sharing
ms-pl | microsoft public | microsoft public licen[cs]e | - | ms pl
ms-rl | microsoft reciprocal | microsoft reciprocal licen[cs]e | - | ms rl
intel | intel open source licen | intel open source licen[cs]e | - | intel
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[cs]e | - | ncsa
openssl | openssl licen | openssl licen[cs]e | - | openssl
postgresql | postgresql licen | postgresql licen[cs]e | - | postgresql
sleepycat | sleepycat licen | sleepycat licen[cs]e | - | sleepycat
lppl | latex project public | latex project public licen[cs]e | 1.0 1.1 1.2 1.3 | lppl
qpl | q public licen | q public licen[cs]e | 1.0 | qpl
nethack | nethack general public | nethack general public licen[cs]e | - | ngpl
vim | vim licen | vim licen[cs]e | - | vim
w3c | w3c | w3c software(?: notice and)? licen[cs]e | - | w3c
upl | universal permissive | universal permissive licen[cs]e | 1.0 | upl
sspl | server side public | server side public licen[cs]e | 1.0 | sspl
busl | business source | business source licen[cs]e | 1.1 | busl
elastic | elastic licen | elastic licen[cs]e | 2.0 | elastic
commons-clause | commons clause | commons clause(?: licen[cs]e condition)? | 1.0 | -
polyform | polyform | polyform (?:noncommercial|small business|shield|strict|free trial|internal use)(?: licen[cs]e)? | 1.0 | -
openrail | openrail | (?:creativeml |bigscience )?(?:bloom )?openrail(?: m)?(?: licen[cs]e)? | - | -
all-rights-reserved | all rights reserved | all rights reserved | - | -
"""

#: The Creative Commons conditions: label, short form, words that name it.
CREATIVE = """
cc-by-nc-nd | by nc nd | attribution non ?commercial no ?deriv(?:s|ative works|atives)
cc-by-nc-sa | by nc sa | attribution non ?commercial share ?alike
cc-by-nc | by nc | attribution non ?commercial
cc-by-nd | by nd | attribution no ?deriv(?:s|ative works|atives)
cc-by-sa | by sa | attribution share ?alike
cc-by | by | attribution
"""
CREATIVE_VERSIONS = "1.0 2.0 2.5 3.0 4.0"

#: label | keyword | sentence of the license's text or notice
SENTENCES = """
mit | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy
mit | the software is provided as is without warranty of any kind | the software is provided as is without warranty of any kind express or implied
isc | permission to use copy modify and or distribute this software | permission to use copy modify and or distribute this software for any purpose with or without fee
isc | the software is provided as is and the author disclaims | the software is provided as is and the author disclaims all warranties
bsd | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted
bsd | redistributions of source code must retain | redistributions of source code must retain the above copyright notice
bsd | redistributions in binary form must reproduce | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause | may be used to endorse or promote products | (?:neither the names? of|the names? of) .{1,120}? may be used to endorse or promote products derived from this software
bsd-4-clause | all advertising materials mentioning features | all advertising materials mentioning features or use of this software must display
zlib | the origin of this software must not be misrepresented | the origin of this software must not be misrepresented
zlib | altered source versions must be plainly marked | altered source versions must be plainly marked as such
gpl | it under the terms of the gnu general public | (?:this program is free software )?you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl | you should have received a copy of the gnu general public | you should have received a copy of the gnu general public licen[cs]e
gpl | the licenses for most software are designed to take away | the licenses for most software are designed to take away your freedom
lgpl | you should have received a copy of the gnu lesser | you should have received a copy of the gnu lesser general public licen[cs]e
lgpl | it under the terms of the gnu lesser | you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e
lgpl | it under the terms of the gnu library | you can redistribute it and or modify it under the terms of the gnu library general public licen[cs]e
agpl | you should have received a copy of the gnu affero | you should have received a copy of the gnu affero general public licen[cs]e
agpl | it under the terms of the gnu affero | you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e
gfdl | under the terms of the gnu free documentation | copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
gfdl | no invariant sections | no invariant sections no front cover texts and no back cover texts
apache-2.0 | you may not use this file except in compliance with the | you may not use this file except in compliance with the licen[cs]e
apache-2.0 | unless required by applicable law or agreed to in writing | unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis
apache-1.1 | this product includes software developed by the apache | this product includes software developed by the apache (?:software foundation|group)
mpl-1.1 | are subject to the mozilla public | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
mpl-2.0 | this source code form is subject to the terms of the mozilla | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
epl-1.0 | under the terms of the eclipse public | made available under the terms of the eclipse public licen[cs]e v1 0
epl-2.0 | under the terms of the eclipse public | made available under the terms of the eclipse public licen[cs]e 2 0
cddl | subject to the terms of the common development | subject to the terms of the common development and distribution licen[cs]e
bsl-1.0 | distributed under the boost software | distributed under the boost software licen[cs]e version 1 0
unlicense | free and unencumbered software released into the public domain | this is free and unencumbered software released into the public domain
wtfpl | do what the fuck you want to public | do what the fuck you want to public licen[cs]e
ofl-1.1 | this font software is licensed under the sil | this font software is licensed under the sil open font licen[cs]e version 1 1
artistic | under the same terms as perl itself | you (?:can|may) redistribute it and or modify it under the same terms as perl itself
postgresql | permission to use copy modify and distribute this software and its documentation | permission to use copy modify and distribute this software and its documentation for any purpose without fee
openssl | developed by the openssl project | this product includes software developed by the openssl project
ncsa | deal with the software without restriction | to deal with the software without restriction
public-domain | into the public domain | (?:released|placed|dedicated|put|donated) (?:[^ ]+ ){0,4}?into the public domain
public-domain | is in the public domain | this (?:work|file|code|software|document|text|image|book|program) is in the public domain
public-domain | dedicated to the public domain | dedicated to the public domain
cc0 | waived all copyright and related | waived all copyright and related (?:and|or) neighboring rights
all-rights-reserved | no part of this | no part of this (?:publication|book|work|document) may be reproduced
proprietary | proprietary and confidential | proprietary and confidential
proprietary | unauthorized copying of this file | unauthorized copying of this file
proprietary | strictly prohibited without | (?:reproduction|copying|distribution|redistribution|use) (?:[^ ]+ ){0,6}?is strictly prohibited without
"""

#: label | keyword | address (its words)
ADDRESSES = """
gpl | gnu org licenses gpl | gnu org licenses gpl(?: html| txt| en html)?
gpl-2.0 | gnu org licenses | gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0 | gnu org licenses | gnu org licenses gpl 3 0
lgpl | gnu org licenses | gnu org licenses lgpl
lgpl-2.1 | gnu org licenses | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3.0 | gnu org licenses | gnu org licenses lgpl 3 0
agpl-3.0 | gnu org licenses | gnu org licenses agpl(?: 3 0)?
gfdl | gnu org licenses | gnu org licenses fdl(?: 1 [123])?
gpl | gnu org copyleft gpl | gnu org copyleft gpl
apache-2.0 | apache org licenses license 2 0 | apache org licenses license 2 0
apache-1.1 | apache org licenses license 1 1 | apache org licenses license 1 1
mpl-2.0 | mozilla org | mozilla org (?:en us )?mpl 2 0
mpl-1.1 | mozilla org | mozilla org mpl mpl 1 1
epl-1.0 | eclipse org legal | eclipse org legal epl v10
epl-2.0 | eclipse org legal | eclipse org legal epl (?:v20|2 0)
mit | opensource org licenses mit | opensource org licenses mit(?: license)?
isc | opensource org licenses isc | opensource org licenses isc
bsd-2-clause | opensource org licenses bsd | opensource org licenses bsd 2 clause
bsd-3-clause | opensource org licenses bsd | opensource org licenses bsd 3 clause
bsd | opensource org licenses bsd | opensource org licenses bsd license
apache-2.0 | opensource org licenses apache | opensource org licenses apache 2 0
zlib | opensource org licenses zlib | opensource org licenses zlib
artistic-2.0 | opensource org licenses artistic | opensource org licenses artistic(?: license)? 2 0
cddl-1.0 | opensource org licenses cddl | opensource org licenses cddl 1 0
bsl-1.0 | boost org | boost org license 1 0
ofl | scripts sil org | scripts sil org ofl
unlicense | unlicense org | unlicense org
wtfpl | wtfpl net | wtfpl net
odbl-1.0 | opendatacommons org licenses odbl | opendatacommons org licenses odbl(?: 1 0)?
odc-by-1.0 | opendatacommons org licenses by | opendatacommons org licenses by(?: 1 0)?
pddl-1.0 | opendatacommons org licenses pddl | opendatacommons org licenses pddl(?: 1 0)?
ogl-uk-3.0 | nationalarchives gov uk | nationalarchives gov uk doc open government licence version 3
cc0-1.0 | creativecommons org publicdomain zero | creativecommons org publicdomain zero 1 0
public-domain-mark-1.0 | creativecommons org publicdomain mark | creativecommons org publicdomain mark 1 0
python | docs python org | docs python org (?:\\d )*license
php-3.01 | php net license | php net license 3 01
"""

GRANT = (
    r"(?:licen[cs]ed|released|distributed|available|published|provided|shared|offered|open sourced|issued|covered|governed) "
    r"(?:[^ ]+ ){0,2}?(?:under|by|subject to) (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?"
)
LATER = " or (?:at your option )?(?:any )?(?:later|newer)(?: versions?)?"


def _version(version: str) -> str:
    """The ways to write a version behind a name; "3.0" is "3" as well."""
    words = version.replace(".", " ")
    number = words.removesuffix(" 0") + "(?: 0)?" if words.endswith(" 0") else words
    return rf"(?: ?v| (?:licen[cs]e )?(?:version |ver |v )?){number}(?! \d)"


def _spdx(stem: str, version: str | None) -> str:
    number = "" if version is None else " " + version.replace(".", " ")
    return rf"spdx license identifier {stem}{number}(?: only| or later)?"


def _lines(table: str) -> list[list[str]]:
    return [line.split(" | ") for line in table.strip().split("\n")]


def build_rules() -> list[Rule]:
    """All rules in their order; of two equal places the earlier rule's is kept."""
    found: list[tuple[str, str, str, str]] = []  # kind, label, keyword, pattern

    def named(label: str, keyword: str, name: str, versions: str, stem: str) -> None:
        numbers = [] if versions == "-" else versions.split()
        for version in numbers:
            full = f"{label}-{version}"
            if stem != "-":
                found.append(("spdx", full, "spdx license identifier", _spdx(stem, version)))
            found.append(("later", f"{full}-or-later", keyword, name + _version(version) + LATER))
            found.append(("grant", full, keyword, GRANT + name + _version(version)))
            found.append(("version", full, keyword, name + _version(version)))
        if stem != "-" and not numbers:
            found.append(("spdx", label, "spdx license identifier", _spdx(stem, None)))
        found.append(("grant", label, keyword, GRANT + name))
        found.append(("name", label, keyword, name))

    for kind, table in (("sentence", SENTENCES), ("address", ADDRESSES)):
        found += [(kind, *line) for line in _lines(table)]
    for line in _lines(NAMES):
        named(*line)
    for label, short, words in _lines(CREATIVE):
        named(label, f"cc {short}", f"cc {short}(?: licen[cs]e)?", CREATIVE_VERSIONS, f"cc {short}")
        named(label, "creative commons", f"creative commons {words}(?: licen[cs]e)?", CREATIVE_VERSIONS, "-")
        for version in CREATIVE_VERSIONS.split():
            address = f"creativecommons org licenses {short} {version.replace('.', ' ')}"
            found.append(("address", f"{label}-{version}", address, address))
    found.append(("grant", "creative-commons", "creative commons", GRANT + "creative commons(?: licen[cs]e)?"))
    return [Rule(label, kind, *KINDS[kind], keyword, re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")) for kind, label, keyword, pattern in found]


RULES = build_rules()
