"""Signatures of licences, over texts reduced to lower-case words with single spaces.

Each family has a label, a keyword that every match of its name holds, the pattern of its name, and the pattern of
its short identifier. ``RULES`` derives from each family, in falling priority: the tagged identifier,
a grant under the name, the name itself, and a link to the text. Hand-written rules of single licences follow; every
match of one holds its keyword too. ``GATES`` derives from all: every match of every rule holds one of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

# label | keyword | name | identifier
FAMILIES = """
gpl | general public license | (gnu )?general public license( (as published by the free software foundation )?(either )?(version|v) ?\\d( \\d)?)?( or (any )?later( version)?)? | (a?l?gpl) ?\\d( \\d)?( only| or later)?
gpl-2 | general public license | (gnu )?general public license (version |v)2( 0)? | gpl ?2( 0)?( only| or later)?
gpl-3 | general public license | (gnu )?general public license (version |v)3( 0)? | gpl ?3( 0)?( only| or later)?
lgpl | lesser general public license | (gnu )?lesser general public license( (version |v)\\d( \\d)?)? | lgpl ?\\d( \\d)?( only| or later)?
lgpl | library general public license | (gnu )?library general public license( (version |v)\\d( \\d)?)? | lgpl ?2( 0)?
agpl | affero general public license | (gnu )?affero general public license( (version |v)\\d( \\d)?)? | agpl ?\\d( \\d)?( only| or later)?
gfdl | free documentation license | (gnu )?free documentation license( (version |v)\\d( \\d)?)? | gfdl ?\\d( \\d)?
apache | apache | apache (software )?licen[sc]e( (version |v)?\\d( \\d)?)? | apache ?\\d( \\d)?
apache-2 | apache | apache (software )?licen[sc]e (version |v)?2( 0)? | apache ?2( 0)?
mit | licen | (the )?(mit|expat) licen[sc]e | mit( 0)?
x11 | x11 | x11 licen[sc]e | x11
bsd | bsd | (\\w+ clause )?bsd( style)? licen[sc]e | bsd ?\\d clause
bsd-2 | bsd | (bsd (2|two) clause|(2|two) clause bsd|simplified bsd|freebsd) licen[sc]e | bsd ?2 clause
bsd-3 | bsd | (bsd (3|three) clause|(3|three) clause bsd|new bsd|modified bsd|revised bsd) licen[sc]e | bsd ?3 clause
bsd-4 | bsd | (bsd (4|four) clause|(4|four) clause bsd|original bsd) licen[sc]e | bsd ?4 clause
isc | isc | (the )?isc licen[sc]e | isc
mpl | mozilla | mozilla public licen[sc]e( (version |v)?\\d( \\d)?)? | mpl ?\\d( \\d)?
epl | eclipse | eclipse public licen[sc]e( (version |v)?\\d( \\d)?)? | epl ?\\d( \\d)?
edl | eclipse | eclipse distribution licen[sc]e( (version |v)?\\d( \\d)?)? | edl ?\\d( \\d)?
cddl | common development | common development and distribution licen[sc]e( (version |v)?\\d( \\d)?)? | cddl ?\\d( \\d)?
cpl | common public | common public licen[sc]e( (version |v)?\\d( \\d)?)? | cpl ?\\d( \\d)?
ibm-pl | ibm public | ibm public licen[sc]e( (version |v)?\\d( \\d)?)? | ipl ?\\d( \\d)?
artistic | artistic | (the )?artistic licen[sc]e( (version |v)?\\d( \\d)?)? | artistic ?\\d( \\d)?
zlib | zlib | zlib( libpng)? licen[sc]e | zlib
libpng | libpng | libpng licen[sc]e( (version |v)?\\d( \\d)?)? | libpng( \\d \\d)?
boost | boost | boost software licen[sc]e( (version |v)?\\d( \\d)?)? | bsl ?1( 0)?
unlicense | unlicense | (the )?unlicense | unlicense
wtfpl | what the | do what the \\w+ you want to public licen[sc]e | wtfpl
cc0 | cc0 | (creative commons )?cc0( 1 0)?( universal)? | cc0( 1 0)?
cc-by | creative commons | creative commons attribution( \\d \\d)?( international| unported| generic)? | cc by( \\d \\d)?
cc-by-sa | share | (creative commons )?attribution share ?alike( \\d \\d)?( international| unported| generic)? | cc by sa( \\d \\d)?
cc-by-nc | noncommercial | (creative commons )?attribution noncommercial( \\d \\d)?( international| unported| generic)? | cc by nc( \\d \\d)?
cc-by-nc | non commercial | (creative commons )?attribution non commercial( \\d \\d)?( international| unported| generic)? | cc by nc( \\d \\d)?
cc-by-nd | deriv | (creative commons )?attribution no ?deriv(s|atives)( \\d \\d)?( international| unported| generic)? | cc by nd( \\d \\d)?
cc-by-nc-sa | share | (creative commons )?attribution non ?commercial share ?alike( \\d \\d)?( international| unported| generic)? | cc by nc sa( \\d \\d)?
cc-by-nc-nd | deriv | (creative commons )?attribution non ?commercial no ?deriv(s|atives)( \\d \\d)?( international| unported| generic)? | cc by nc nd( \\d \\d)?
odbl | open database | (odc )?open database licen[sc]e( (version |v)?\\d( \\d)?)? | odbl ?1( 0)?
odc-by | open data commons | open data commons attribution licen[sc]e( (version |v)?\\d( \\d)?)? | odc by ?1( 0)?
pddl | open data commons | open data commons public domain dedication( and licen[sc]e)? | pddl ?1( 0)?
cdla | community data | community data licen[sc]e agreement( (permissive|sharing))?( (version )?\\d( \\d)?)? | cdla (permissive|sharing) \\d \\d
ogl | open government | open government licen[sc]e( (version |v)?\\d( \\d)?)? | ogl uk \\d \\d
ofl | open font | (sil )?open font licen[sc]e( (version |v)?\\d( \\d)?)? | ofl ?1( \\d)?
openrail | rail | (bigscience |creativeml )?(open ?)?rail( m)? licen[sc]e | openrail
psf | python software | python software foundation licen[sc]e( (version |v)?\\d( \\d)?)? | (psf|python) ?2( 0)?
php | php | php licen[sc]e( (version |v)?\\d( \\d)?)? | php ?3( 0)?( 1)?
ruby | ruby | ruby licen[sc]e | ruby
perl | perl | same terms as perl( 5)?( itself)? | perl ?5
openssl | openssl | openssl licen[sc]e | openssl
ssleay | ssleay | (original )?ssleay licen[sc]e | ssleay
postgresql | postgresql | postgresql licen[sc]e | postgresql
curl | curl | curl licen[sc]e | curl
ncsa | ncsa | (university of illinois )?ncsa open source licen[sc]e | ncsa
ecl | educational community | educational community licen[sc]e( (version |v)?\\d( \\d)?)? | ecl ?\\d( \\d)?
upl | universal permissive | universal permissive licen[sc]e( (version |v)?\\d( \\d)?)? | upl ?1( 0)?
eupl | european union | european union public licen[sc]e( (version |v)?\\d( \\d)?)? | eupl ?1( \\d)?
cecill | cecill | (the )?cecill( (a|b|c))?( free software)? licen[sc]e( (version )?\\d( \\d)?)? | cecill( (a|b|c))?( \\d \\d)?
ms-pl | microsoft | microsoft public licen[sc]e | ms pl
ms-rl | microsoft | microsoft reciprocal licen[sc]e | ms rl
apsl | apple | apple public source licen[sc]e( (version |v)?\\d( \\d)?)? | apsl ?\\d( \\d)?
osl | open software | open software licen[sc]e( (version |v)?\\d( \\d)?)? | osl ?\\d( \\d)?
afl | academic free | academic free licen[sc]e( (version |v)?\\d( \\d)?)? | afl ?\\d( \\d)?
qpl | q public | (the )?q public licen[sc]e( (version |v)?\\d( \\d)?)? | qpl ?1( 0)?
lppl | latex project | latex project public licen[sc]e( (version |v)?\\d( \\d)?)? | lppl ?\\d( \\d)?\\w?
rpl | reciprocal public | reciprocal public licen[sc]e( (version |v)?\\d( \\d)?)? | rpl ?1( \\d)?
sspl | server side public | server side public licen[sc]e( (version |v)?\\d( \\d)?)? | sspl ?1( 0)?
busl | business source | business source licen[sc]e( (version |v)?\\d( \\d)?)? | busl ?1( 1)?
elastic | elastic | elastic licen[sc]e( (version |v)?\\d( \\d)?)? | elastic ?2( 0)?
commons-clause | commons clause | commons clause( licen[sc]e)?( condition)? | commons clause
polyform | polyform | polyform (noncommercial|small business|strict|shield|perimeter) licen[sc]e( \\d \\d \\d)? | polyform \\w+ \\d \\d \\d
prosperity | prosperity | prosperity public licen[sc]e( \\d \\d \\d)? | prosperity
hippocratic | hippocratic | hippocratic licen[sc]e( (version )?\\d( \\d)?)? | hippocratic ?\\d \\d
blueoak | blue oak | blue oak model licen[sc]e( \\d \\d \\d)? | blueoak ?1 0 0
mulan | mulan | mulan (permissive|public) (software )?licen[sc]e( (version |v)?\\d( \\d)?)? | mulan ?p[su]l ?\\d \\d
vim | vim | (the )?vim licen[sc]e | vim
sleepycat | sleepycat | sleepycat (public )?licen[sc]e | sleepycat
tcl | tcl | tcl( tk)? licen[sc]e | tcl
unicode | unicode | unicode( data files and software)? licen[sc]e( agreement)? | unicode (dfs|tou)( \\d{4})?
w3c | w3c | w3c software( notice)?( and)?( document)? licen[sc]e | w3c
icu | icu | icu licen[sc]e | icu
hpnd | historical permission | historical permission notice and disclaimer | hpnd
beerware | beer | (the )?beer ?ware licen[sc]e | beerware
json | json | (the )?json licen[sc]e | json
naist | naist | naist( 2003)? licen[sc]e | naist 2003
cpal | common public attribution | common public attribution licen[sc]e( (version |v)?\\d( \\d)?)? | cpal ?1( 0)?
watcom | watcom | sybase open watcom public licen[sc]e( \\d \\d)? | watcom ?1( 0)?
nasa | nasa | nasa open source agreement( \\d \\d)? | nasa ?1( 3)?
spl | sun public | sun public licen[sc]e( (version |v)?\\d( \\d)?)? | spl ?1( 0)?
zpl | zope | zope public licen[sc]e( (version |v)?\\d( \\d)?)? | zpl ?\\d( \\d)?
llama | llama | llama( \\d)? community licen[sc]e( agreement)? | llama ?\\d
gemma | gemma | gemma (terms of use|licen[sc]e) | gemma
"""

# label | keyword | pattern | weight: wording of single licences and notices, in falling priority
SINGLE = """
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy | 0.95
mit | without restriction including | without restriction including without limitation the rights to use copy modify merge publish | 0.95
bsd | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted | 0.95
bsd-3 | endorse or promote | neither the names? of .{1,80}? (be used|may be used) to endorse or promote products | 0.9
isc | permission to use copy modify | permission to use copy modify and( or)? distribute this software for any purpose with or without fee | 0.95
zlib | provided as is without any express | this software is provided as is without any express or implied warranty in no event will the authors | 0.9
gpl | you can redistribute it and or modify | you can redistribute it and or modify it under the terms of the gnu (lesser |affero )?general public license | 0.95
apache-2 | limitations under the license | see the license for the specific language governing permissions and limitations under the license | 0.95
apache-2 | www apache org | (https? )?www apache org licenses license 2 0 | 0.9
mpl | mozilla org mpl | (https? )?(www )?mozilla org mpl( \\d \\d)? | 0.9
gpl | gnu org licenses | (https? )?(www )?gnu org licenses( old licenses)? (a?l?gpl|fdl)( \\d \\d)? | 0.9
cc-by | creativecommons org licenses by | (https? )?(www )?creativecommons org licenses by( \\d \\d)? | 0.9
cc-by-sa | creativecommons org licenses by sa | (https? )?(www )?creativecommons org licenses by sa( \\d \\d)? | 0.9
cc-by-nc | creativecommons org licenses by nc | (https? )?(www )?creativecommons org licenses by nc( \\d \\d)? | 0.9
cc0 | creativecommons org publicdomain | (https? )?(www )?creativecommons org publicdomain zero( 1 0)? | 0.9
mit | opensource org licenses mit | (https? )?(www )?opensource org licenses mit | 0.9
bsd | opensource org licenses bsd | (https? )?(www )?opensource org licenses bsd( \\d clause)? | 0.9
boost | boost org license | (https? )?(www )?boost org license 1 0 txt | 0.9
unlicense | unlicense org | (https? )?(www )?unlicense org | 0.9
unlicense | free and unencumbered | this is free and unencumbered software released into the public domain | 0.95
public-domain | public domain | (dedicated|released|placed|donated) (in|in ?to) the public domain | 0.8
wtfpl | you just do what | you just do what the \\w+ you want to | 0.9
proprietary | all rights reserved | (copyright .{1,60}? )?all rights reserved | 0.4
proprietary | proprietary and confidential | proprietary and confidential | 0.7
proprietary | permission | (may|must) not be (copied|reproduced)( or)? .{1,60}? without (the )?(prior |express )?(written )?permission | 0.6
"""

# words that many rules share; GATES adds the keywords of the other rules
COMMON = ("licen", "spdx", "public domain", "rights reserved", "confidential", "permission", "redistribut", "creative commons",
          "creativecommons", "cc by", "cc0", "open source", "terms of", "copyright", "endorse or", "org mpl", "free software", "you just do", "attribution", "commons clause", "notice and disclaimer")
UNKNOWN = "\0"  # stands for what a match may hold at a place, and is part of no literal
TOKEN = re.compile(r"\[[^]]*\]|\\.|[().|]|[^\\\[().|?*+{]")
TIMES = re.compile(r"[?*+]\??|\{\d+(,\d*)?\}\??")


def forms(pattern: str) -> list[str]:
    """Strings that stand for all matches of ``pattern``: literal where a match is, UNKNOWN elsewhere."""

    def either(at: int) -> tuple[list[str], int]:
        done, now = [], [""]
        while at < len(pattern) and pattern[at] != ")":
            if pattern[at] == "|":
                done, now, at = done + now, [""], at + 1
                continue
            token = TOKEN.match(pattern, at)[0]
            if token == "(":
                own, at = either(at + 1)
                at += 1
            else:
                own, at = [UNKNOWN if token[0] in "[\\." else token], at + len(token)
            times = TIMES.match(pattern, at)
            if times:
                at = times.end()
                own = ["", *own] if times[0] == "?" else [UNKNOWN] if times[0][0] == "+" else ["", UNKNOWN]
            now = list(dict.fromkeys(a + b for a in now for b in own))
        return done + now, at

    found, end = either(0)
    if end < len(pattern):
        raise ValueError(f"unbalanced pattern: {pattern}")
    return found


def implied(pattern: str, words: Iterable[str]) -> bool:
    """Whether every match of ``pattern`` holds one of ``words``."""
    return all(any(w in form for w in words) for form in forms(pattern))


@dataclass(frozen=True)
class Rule:
    priority: int  # a lower number wins
    label: str
    keyword: str
    pattern: str
    weight: float
    core: str  # a part of the pattern that every match holds


def _derived() -> list[Rule]:
    rules = []
    for line in FAMILIES.strip().splitlines():
        label, keyword, name, short = (x.strip() for x in line.split(" | "))
        rules += [
            Rule(1, label, "spdx license identifier", f"spdx license identifier {short}", 1.0, "spdx license identifier"),
            Rule(2, label, keyword, f"(licensed|released|distributed|available|published|provided|made available|shared) (under|according to|subject to)( the)?( terms( and conditions)? of)?( the)? {name}", 0.95, name),
            Rule(3, label, keyword, name, 0.8, name),
            Rule(4, label, "licen", f"licen[sc]e[ds]?( (is|under|type|name|id|the))* {short}", 0.6, "licen[sc]e"),
        ]
    return rules


def _single() -> list[Rule]:
    rules = []
    for line in SINGLE.strip().splitlines():
        label, keyword, pattern, weight = (x.strip() for x in line.split(" | "))
        rules.append(Rule(2, label, keyword, pattern, float(weight), pattern))
    return rules


RULES = tuple(_derived() + _single())
GATES = (*COMMON, *dict.fromkeys(r.keyword for r in RULES if not implied(r.core, COMMON)))
