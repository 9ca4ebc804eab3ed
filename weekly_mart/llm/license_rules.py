"""Signature rules for license texts, over words joined by one space.

A rule has a priority (1 goes first), the label it gives, keywords of which one
has to occur in the text before the pattern is tried, and the pattern. Every
text that the pattern matches holds one of the keywords. Patterns are written
with single spaces between words, punctuation left out.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    priority: int
    label: str
    keywords: tuple[str, ...]
    pattern: str


#: label, pattern of the license's name, words of its SPDX identifier, words to look for first, "|" between them:
#: every alternative of the name holds one
LICENSES = [
    ("mit", r"(?:mit|expat)(?: x11)?(?: style)? licen[cs]e|mit", "mit", "mit|expat"),
    ("mit-0", r"mit no attribution(?: licen[cs]e)?", "mit 0", "attribution"),
    ("apache-2.0", r"apache(?: software)?(?: licen[cs]e)?(?: v| version)? ?2(?: 0)?", "apache 2 0", "apache"),
    ("apache-1.1", r"apache(?: software)? licen[cs]e(?: v| version)? ?1 1", "apache 1 1", "apache"),
    ("apache-1.0", r"apache(?: software)? licen[cs]e(?: v| version)? ?1 0", "apache 1 0", "apache"),
    ("gpl-3.0", r"(?:gnu )?(?:general public licen[cs]e|gpl)(?: gpl)?(?: v| version)? ?3(?: 0)?", "gpl 3 0(?: only| or later)?", "3"),
    ("gpl-2.0", r"(?:gnu )?(?:general public licen[cs]e|gpl)(?: gpl)?(?: v| version)? ?2(?: 0)?", "gpl 2 0(?: only| or later)?", "2"),
    ("gpl-1.0", r"(?:gnu )?(?:general public licen[cs]e|gpl)(?: gpl)?(?: v| version)? ?1(?: 0)?", "gpl 1 0(?: only| or later)?", "1"),
    ("lgpl-3.0", r"(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: v| version)? ?3(?: 0)?", "lgpl 3 0(?: only| or later)?", "3"),
    ("lgpl-2.1", r"(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: v| version)? ?2 1", "lgpl 2 1(?: only| or later)?", "2"),
    ("lgpl-2.0", r"(?:gnu )?(?:library general public licen[cs]e|lgpl)(?: v| version)? ?2(?: 0)?", "lgpl 2 0(?: only| or later)?", "2"),
    ("agpl-3.0", r"(?:gnu )?(?:affero general public licen[cs]e|agpl)(?: v| version)? ?3(?: 0)?", "agpl 3 0(?: only| or later)?", "3"),
    ("gfdl-1.3", r"(?:gnu )?(?:free documentation licen[cs]e|gfdl)(?: v| version)? ?1 3", "gfdl 1 3(?: only| or later)?", "3"),
    ("gfdl-1.2", r"(?:gnu )?(?:free documentation licen[cs]e|gfdl)(?: v| version)? ?1 2", "gfdl 1 2(?: only| or later)?", "2"),
    ("bsd-2-clause", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?", "bsd 2 clause", "bsd"),
    ("bsd-3-clause", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd)(?: licen[cs]e)?", "bsd 3 clause", "bsd"),
    ("bsd-4-clause", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: licen[cs]e)?", "bsd 4 clause", "bsd"),
    ("0bsd", r"(?:bsd zero clause|zero clause bsd|0 clause bsd)(?: licen[cs]e)?", "0bsd", "clause"),
    ("isc", r"isc licen[cs]e", "isc", "isc"),
    ("mpl-2.0", r"(?:mozilla public licen[cs]e|mpl)(?: v| version)? ?2(?: 0)?", "mpl 2 0", "2"),
    ("mpl-1.1", r"(?:mozilla public licen[cs]e|mpl)(?: v| version)? ?1 1", "mpl 1 1", "1"),
    ("epl-2.0", r"(?:eclipse public licen[cs]e|epl)(?: v| version)? ?2(?: 0)?", "epl 2 0", "2"),
    ("epl-1.0", r"(?:eclipse public licen[cs]e|epl)(?: v| version)? ?1(?: 0)?", "epl 1 0", "1"),
    ("cddl-1.0", r"(?:common development and distribution licen[cs]e|cddl)(?:(?: v| version)? ?1 0)?", "cddl 1 0", "distribution|cddl"),
    ("cpl-1.0", r"common public licen[cs]e(?:(?: v| version)? ?1 0)?", "cpl 1 0", "common"),
    ("eupl-1.2", r"(?:european union public licen[cs]e|eupl)(?:(?: v| version)? ?1 2)?", "eupl 1 2", "union|eupl"),
    ("osl-3.0", r"open software licen[cs]e(?:(?: v| version)? ?3 0)?", "osl 3 0", "open"),
    ("afl-3.0", r"academic free licen[cs]e(?:(?: v| version)? ?3 0)?", "afl 3 0", "academic"),
    ("artistic-2.0", r"artistic licen[cs]e(?:(?: v| version)? ?2 0)?", "artistic 2 0", "artistic"),
    ("zlib", r"zlib(?: libpng)? licen[cs]e", "zlib", "zlib"),
    ("bsl-1.0", r"boost software licen[cs]e(?:(?: v| version)? ?1 0)?", "bsl 1 0", "boost"),
    ("ms-pl", r"microsoft public licen[cs]e", "ms pl", "microsoft"),
    ("ms-rl", r"microsoft reciprocal licen[cs]e", "ms rl", "microsoft"),
    ("python-2.0", r"(?:python software foundation|psf) licen[cs]e(?:(?: v| version)? ?2)?", "python 2 0", "python|psf"),
    ("php-3.01", r"php licen[cs]e(?:(?: v| version)? ?3 01)?", "php 3 01", "php"),
    ("ruby", r"ruby licen[cs]e", "ruby", "ruby"),
    ("postgresql", r"postgresql licen[cs]e", "postgresql", "postgresql"),
    ("unlicense", r"unlicense", "unlicense", "unlicense"),
    ("wtfpl", r"(?:do what the fuck you want to public licen[cs]e|wtfpl)", "wtfpl", "want|wtfpl"),
    ("ofl-1.1", r"sil open font licen[cs]e(?:(?: v| version)? ?1 1)?", "ofl 1 1", "font"),
    ("odbl-1.0", r"(?:open database licen[cs]e|odbl)(?:(?: v| version)? ?1 0)?", "odbl 1 0", "database|odbl"),
    ("cc0-1.0", r"(?:cc0|creative commons zero|cc zero)(?:(?: v| version)? ?1 0)?(?: universal)?", "cc0 1 0", "cc0|zero"),
] + [
    (f"cc-by{clause}-{version}",
     f"(?:cc by|creative commons attribution){words} (?:v|version )?{version[0]} {version[2]}(?: international| unported| generic)?",
     f"cc by{clause.replace('-', ' ')} {version[0]} {version[2]}", " cc |commons")
    for version in ("4.0", "3.0", "2.5", "2.0")
    for clause, words in (
        ("", ""),
        ("-sa", "(?: sa| share ?alike)"),
        ("-nc", "(?: nc| non ?commercial)"),
        ("-nd", "(?: nd| no ?deriv(?:ative)?s?(?: works)?)"),
        ("-nc-sa", "(?: nc| non ?commercial) (?:sa|share ?alike)"),
        ("-nc-nd", "(?: nc| non ?commercial) (?:nd|no ?deriv(?:ative)?s?(?: works)?)"),
    )
]

_GRANT = (
    r"(?:dual |re)?(?:licen[cs]ed|released|distributed|published|available|provided|covered|offered|made available|issued)"
    r"(?: to you)? (?:under|by|with|according to|subject to)(?: the)?(?: terms(?: and conditions)? of(?: the)?)?"
)

#: Statements that name no particular license.
STATEMENTS = [
    Rule(1, "mit", ("permission",), r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Rule(1, "isc", ("permission",), r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Rule(1, "bsd", ("redistribution",), r"redistribution and use in source and binary forms with or without modification are permitted"),
    Rule(1, "unlicense", ("unencumbered",), r"this is free and unencumbered software released into the public domain"),
    Rule(1, "boost", ("permission",), r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    Rule(1, "zlib", ("warranty",), r"provided as is without any express or implied warranty in no event will the authors be held liable"),
    Rule(1, "gpl", ("free",), r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    Rule(1, "lgpl", ("free",), r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e"),
    Rule(2, "public-domain", ("domain",), r"(?:released (?:in|into|to)|dedicated to|placed in|is in) the public domain"),
    Rule(2, "proprietary", ("rights",), r"all rights reserved"),
    Rule(2, "proprietary", ("confidential",), r"proprietary and confidential"),
    Rule(2, "no-warranty", ("warranty", "provided"), r"(?:without (?:any )?warranty|with absolutely no warranty|provided as is)"),
    Rule(3, "mit", ("mit",), r"mit licen[cs]e"),
    Rule(3, "apache", ("apache",), r"apache licen[cs]e"),
    Rule(3, "gpl", ("public",), r"general public licen[cs]e"),
    Rule(3, "bsd", ("bsd",), r"bsd licen[cs]e"),
    Rule(3, "lgpl", ("lesser",), r"lesser general public licen[cs]e"),
    Rule(3, "agpl", ("affero",), r"affero general public licen[cs]e"),
    Rule(3, "cc", ("commons",), r"creative commons(?: licen[cs]e)?"),
    Rule(3, "mpl", ("mozilla",), r"mozilla public licen[cs]e"),
    Rule(3, "epl", ("eclipse",), r"eclipse public licen[cs]e"),
]


#: Notices and passages of license texts, in the words of their publishers without punctuation.
#: Each holds a gate word in all its forms. One a line: priority, label, words to look for first ("/" between them), and after the colon the pattern.
NOTICES = r"""
1 mit permission: the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
1 mit merchantability: the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
1 curl permission: permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
1 hpnd permission: permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
1 ntp permission: permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted
1 0bsd fee: for any purpose with or without fee is hereby granted the software is provided as is
1 unicode unicode: permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
1 bsd redistributions: redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
1 bsd redistributions: redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation
1 bsd contributors: this software is provided by the (?:copyright holders|authors?|regents) and contributors as is
1 bsd-3-clause promote: may not be used to endorse or promote products derived from this software without specific prior written permission
1 sleepycat accompanied: redistributions in any form must be accompanied by information on how to obtain complete source code
1 ncsa illinois: university of illinois ncsa open source licen[cs]e
1 apache-2.0 compliance: you may not use this file except in compliance with the license you may obtain a copy of the license at
1 apache-2.0 writing: unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
1 apache-2.0 governing: see the license for the specific language governing permissions and limitations under the license
1 apache-2.0 apache: licensed to the apache software foundation asf under one or more contributor license agreements
1 apache-2.0 perpetual: hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
1 mpl-2.0 mozilla: this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
1 mpl-2.0 mpl: if a copy of the mpl was not distributed with this file you can obtain one at
1 mpl-2.0 incompatible: this source code form is incompatible with secondary licenses
1 mpl-1.1 mozilla: the contents of this file are subject to the mozilla public licen[cs]e version 1 1
1 npl-1.1 netscape: the contents of this file are subject to the netscape public licen[cs]e
1 gpl-2.0 option: either version 2 of the license or at your option any later version
1 gpl-3.0 option: either version 3 of the license or at your option any later version
1 gpl gnu: you should have received a copy of the gnu general public licen[cs]e along with this program
1 gpl implied: without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e
1 gpl absolutely: this program comes with absolutely no warranty
1 gpl-2.0 freedom: the licenses for most software are designed to take away your freedom to share and change it
1 gpl-3.0 copyleft: the gnu general public licen[cs]e is a free copyleft licen[cs]e for software and other kinds of works
1 gnu verbatim: everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
1 gpl-linking exception: as a special exception the copyright holders of this library give you permission to link this library
1 lgpl lesser: you should have received a copy of the gnu lesser general public licen[cs]e along with this library
1 lgpl-3.0 incorporates: this version of the gnu lesser general public licen[cs]e incorporates the terms and conditions of version 3
1 lgpl-2.1 successor: this is the first released version of the lesser gpl it also counts as the successor of the gnu library public licen[cs]e
1 agpl affero: you should have received a copy of the gnu affero general public licen[cs]e along with this program
1 agpl-3.0 remote: remote network interaction use with the gnu general public licen[cs]e
1 gfdl document: permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
1 cc creativecommons: to view a copy of this license visit https? (?:www )?creativecommons org
1 cc-by credit: you must give appropriate credit provide a link to the license and indicate if changes were made
1 cc-by-sa contributions: if you remix transform or build upon the material you must distribute your contributions under the same license as the original
1 cc exercising: exercising the licensed rights you accept and agree to be bound by the terms and conditions of this creative commons
1 cc0-1.0 deed: the person who associated a work with this deed has dedicated the work to the public domain
1 cc0-1.0 neighboring/neighbouring: has waived all copyright and related or neighbou?ring rights to this work
1 pddl-1.0 dedication: open data commons public domain dedication and licen[cs]e
1 odc-by-1.0 commons: open data commons attribution licen[cs]e
1 odbl-1.0 database: any rights in individual contents of the database are licensed under the database contents licen[cs]e
1 ogl-uk sector: contains public sector information licensed under the open government licen[cs]e
1 epl-2.0 accompanying: this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e (?:v 2 0|v2 0|2 0)
1 epl-1.0 accompanying: the accompanying program is provided under the terms of this eclipse public licen[cs]e
1 cpl-1.0 accompanying: the accompanying program is provided under the terms of this common public licen[cs]e
1 ipl-1.0 ibm: the accompanying program is provided under the terms of this ibm public licen[cs]e
1 cddl-1.0 distribution: the contents of this file are subject to the terms of the common development and distribution licen[cs]e
1 cddl-1.0 cddl: when distributing covered code include this cddl header notice in each file
1 artistic-2.0 establishes: this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed
1 boost accompanying: distributed under the boost software licen[cs]e version 1 0 see accompanying file
1 wtfpl verbatim: everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
1 fair instrument: usage of the works is permitted provided that this instrument is retained with the works
1 ms-pl accompanying: this license governs use of the accompanying software if you use the software you accept this license
1 ms-rl recipients: for any file you distribute that contains code from the software you must provide recipients the source code to that file along with a copy of this license
1 python-2.0 psf: this license agreement is between the python software foundation psf and the individual or organization licensee
1 python-2.0 psf: psf hereby grants licensee a nonexclusive royalty free world ?wide licen[cs]e
1 php-3.01 php: this product includes php software freely available from
1 lppl-1.3 latex: this work may be distributed and or modified under the conditions of the latex project public licen[cs]e
1 ofl-1.1 font: this font software is licensed under the sil open font licen[cs]e version 1 1
1 eupl-1.2 eupl: licensed under the eupl version 1 2 or as soon they will be approved by the european commission subsequent versions of the eupl
1 cecill cecill: this software is governed by the cecill(?: a| b| c)? license under french law and abiding by the rules of distribution of free software
1 blueoak-1.0 contributor: each contributor licenses you to do everything with this software that would otherwise infringe that contributor s copyright in it
1 upl-1.0 permissive: universal permissive licen[cs]e (?:v |version )?1 0
1 ecl-2.0 educational: licensed under the educational community licen[cs]e version 2 0
1 zpl-2.1 zope: this software is subject to the provisions of the zope public licen[cs]e version 2 1
1 qpl-1.0 q: this file may be distributed under the terms of the q public licen[cs]e
1 w3c obtaining: by obtaining (?:using )?and or copying this work you the licensee agree that you have read understood and will comply
1 cern-ohl hardware: this source describes open hardware and is licensed under the cern ohl
1 solderpad solderpad: licensed under the solderpad hardware licen[cs]e
1 sspl-1.0 service: you must make the service source code available via network download to everyone at no charge under the terms of this license
1 sspl-1.0 server: server side public licen[cs]e
1 busl-1.1 licensor: the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
1 busl-1.1 business: business source licen[cs]e 1 1
1 elastic-2.0 elastic: licensed under the elastic licen[cs]e
1 commons-clause sell: the grant of rights under the license will not include and the license does not grant to you the right to sell the software
1 polyform polyform: polyform (?:noncommercial|small business|shield|strict|internal use) licen[cs]e 1 0 0
1 confluent-community confluent: licensed under the confluent community licen[cs]e
1 openrail openrail/rail: (?:creativeml )?open ?rail(?: m| s| d)? licen[cs]e
1 llama llama: licensed under the llama [23] community licen[cs]e
2 eula eula: this end user licen[cs]e agreement eula is a legal (?:agreement|contract) between you
2 eula sold: the software is licensed not sold
2 eula transferable: grants you a (?:limited |personal )?non exclusive non transferable (?:revocable )?licen[cs]e
2 proprietary confidential: this software is the confidential and proprietary information of
2 proprietary license: use is subject to license terms
2 proprietary government: u s government users restricted rights
2 proprietary evaluation: licensed for evaluation purposes only
2 proprietary redistributed: this material may not be published broadcast rewritten or redistributed
2 gpl-or-mit dual: dual licensed under (?:the )?(?:mit and gpl|gpl and mit|mit or gpl|mit or apache 2 0|apache 2 0 or mit)
"""  # noqa: E501


def _notices() -> list[Rule]:
    found = []
    for line in NOTICES.strip().splitlines():
        head, pattern = line.split(": ", 1)
        priority, label, words = head.split(" ")
        found.append(Rule(int(priority), label, tuple(words.split("/")), pattern))
    return found


def rules() -> list[Rule]:
    """All rules: four forms for each license, then notices and statements, in order of trial."""
    found = []
    for label, name, spdx, first in LICENSES:
        keywords = tuple(first.split("|"))
        found += [
            Rule(1, label, ("spdx",), rf"spdx licen[cs]e identifier {spdx}"),
            Rule(1, label, keywords, rf"{_GRANT} (?:{name})"),
            Rule(2, label, keywords, rf"(?:licen[cs]e|licen[cs]ing)(?: is| type| name)? (?:{name})"),
            Rule(2, label, keywords, rf"(?:{name})(?: licen[cs]e(?: agreement| terms)?| licensed)"),
        ]
    return found + _notices() + STATEMENTS


#: One of these is part of every text that a rule can match; texts without are not scanned.
GATES = ("licen", "spdx", "permission", "redistribution", "unencumbered", "warranty", "public domain",
         "rights reserved", "confidential", "provided as is", "released", "distributed", "published",
         "available", "provided", "covered", "offered", "issued", "creative", "mozilla", "eclipse")
