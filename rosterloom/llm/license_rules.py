"""Signature rules of licences, over canonical text: lower case, words parted by
one space, no punctuation ("GPL-2.0+" reads "gpl 2 0").

A line is ``priority label keyword: regex``. Each match of a regex holds the
rule's keyword, which may start or end within a word, and a rule is tried only
where its keyword occurs, in one of the words in which the regex can have it. A
lower priority number is a stronger rule. The order of lines breaks ties.
"""

from __future__ import annotations

from itertools import product
from typing import NamedTuple


class Rule(NamedTuple):
    priority: int
    label: str
    keyword: str
    regex: str
    base: bool = False


#: Phrases that are always reported, by the words that stand consecutively.
BASE = [
    Rule(50, "gpl", "gnu general public license", "gnu general public license", True),
    Rule(50, "apache", "apache license", "apache license", True),
    Rule(50, "cc-by", "cc by", "cc by", True),
    Rule(50, "mit", "mit license", "mit license", True),
]

_RULES = r"""
10 agpl-3.0 affero: gnu affero general public license (as published by the free software foundation )?(either )?(version |v ?)3
12 agpl-3.0 agpl: spdx license identifier agpl 3 0( only| or later)?
14 agpl-3.0 agpl: (gnu )?agpl ?v?3( 0)?( only| or later)?
16 agpl-3.0 agpl: www gnu org licenses agpl( 3 0)?( html| txt)?
18 agpl-1.0 affero: affero general public license (version |v ?)1
20 agpl affero: (gnu )?affero general public licen[cs]e
22 agpl affero: affero gpl
24 agpl agpl: licensed under (the )?agpl
10 lgpl-2.0 library: gnu library general public license version 2
11 lgpl-2.0 library: gnu library general public licen[cs]e( as published by the free software foundation)?( either)? (version |v ?)2
12 lgpl-2.1 lgpl: spdx license identifier lgpl 2 1( only| or later)?
12 lgpl-3.0 lgpl: spdx license identifier lgpl 3 0( only| or later)?
14 lgpl-2.1 lesser: gnu lesser general public license( as published by the free software foundation)?( either)? (version |v ?)2 1
14 lgpl-3.0 lesser: gnu lesser general public license( as published by the free software foundation)?( either)? (version |v ?)3
16 lgpl-2.1 lgpl: (gnu )?lgpl ?v?2 1( only| or later)?
16 lgpl-3.0 lgpl: (gnu )?lgpl ?v?3( 0)?( only| or later)?
17 lgpl-2.0 lgpl: (gnu )?lgpl ?v?2 0( only| or later)?
20 lgpl lesser: (gnu )?lesser general public licen[cs]e
20 lgpl library: (gnu )?library general public licen[cs]e
22 lgpl lgpl: licensed under (the )?(gnu )?lgpl
24 lgpl lesser: lesser gpl
10 gpl-2.0 general public license: gnu general public license( as published by the free software foundation)?( either)? (version |v ?)2( or at your option any later version)?
10 gpl-3.0 general public license: gnu general public license( as published by the free software foundation)?( either)? (version |v ?)3( or at your option any later version)?
11 gpl-1.0 general public license: gnu general public license( as published by the free software foundation)?( either)? (version |v ?)1
12 gpl-2.0 gpl: spdx license identifier gpl 2 0( only| or later)?
12 gpl-3.0 gpl: spdx license identifier gpl 3 0( only| or later)?
12 gpl-1.0 gpl: spdx license identifier gpl 1 0( only| or later)?
14 gpl-2.0 gpl: (gnu )?gpl ?(version |v)?2( 0)?( only| or later)?
14 gpl-3.0 gpl: (gnu )?gpl ?(version |v)?3( 0)?( only| or later)?
15 gpl-2.0 gplv2: gplv2( 0)?( only| or later)?
14 agpl-3.0 agplv3: agplv3( 0)?( only| or later)?
15 lgpl-2.1 lgplv2: lgplv2( 1)?( only| or later)?
15 lgpl-3.0 lgplv3: lgplv3( 0)?( only| or later)?
15 gpl-2.0 gpl2: gpl2( 0)?( only| or later)?
15 gpl-3.0 gpl3: gpl3( 0)?( only| or later)?
15 gpl-3.0 gplv3: gplv3( 0)?( only| or later)?
16 gpl-2.0 gnu: www gnu org licenses (old licenses )?gpl 2 0( html| txt)?
16 gpl-3.0 gnu: www gnu org licenses gpl 3 0( html| txt)?
18 gpl-2.0-classpath classpath: (gpl|general public license) (version |v)?2( 0)? with (the )?classpath exception
18 gpl-classpath classpath: classpath exception
18 gpl-gcc runtime library: gcc runtime library exception
18 gpl-font font exception: (gpl|general public license) .{0,40}font exception
18 gpl-autoconf autoconf: autoconf exception
22 gpl free software: this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
23 gpl free software: is free software you can redistribute it and or modify it
24 gpl general public: distributed under the terms of the gnu general public licen[cs]e
25 gpl gpl: licensed under (the )?(gnu )?gpl
26 gpl general public licence: gnu general public licence
28 gpl warranty: without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
30 gpl copyleft: gnu copyleft
10 gfdl-1.1 documentation: gnu free documentation license (version |v ?)1 1
10 gfdl-1.2 documentation: gnu free documentation license (version |v ?)1 2
10 gfdl-1.3 documentation: gnu free documentation license (version |v ?)1 3
12 gfdl gfdl: gfdl 1 [123]( only| or later)?
20 gfdl documentation: gnu free documentation licen[cs]e
22 gfdl gfdl: licensed under (the )?gfdl
10 apache-2.0 apache: apache license (version |v)?2( 0)?
11 apache-2.0 apache: spdx license identifier apache 2 0
12 apache-2.0 apache: apache ?(version |v)?2 0
12 apache-2.0 apache: www apache org licenses license 2 0( html| txt)?
13 apache-2.0 apache: licensed under the apache license version 2 0( the license)?
14 apache-1.1 apache: apache (software )?license (version |v)?1 1
14 apache-1.0 apache: apache (software )?license (version |v)?1 0
15 apache-1.1 apache: spdx license identifier apache 1 1
15 apache-1.0 apache: spdx license identifier apache 1 0
16 apache-2.0 compliance: you may not use this file except in compliance with the license you may obtain a copy of the license
18 apache-2.0 limitations: see the license for the specific language governing permissions and limitations under the license
20 apache apache: apache software licen[cs]e
22 apache apache: apache licen[cs]e
24 apache apache: licensed to the apache software foundation asf
26 apache asl: asl 2 0
10 mit mit: spdx license identifier mit
12 mit-0 mit: mit (no attribution|0)( license)?
12 mit-modern mit: mit modern variant
14 mit permission: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
16 mit copyright notice: the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
18 mit mit: (released|licensed|distributed|available|provided) under (the )?(terms of )?(the )?mit( x11)? licen[cs]e
20 mit mit: mit style licen[cs]e
20 mit mit: (the )?mit licen[cs]e
21 mit expat: expat licen[cs]e
21 x11 x11: x11 licen[cs]e
22 mit opensource: opensource org licenses mit( license)?
24 mit mit: mit licensed
10 bsd-2-clause bsd: spdx license identifier bsd 2 clause
10 bsd-3-clause bsd: spdx license identifier bsd 3 clause
10 bsd-4-clause bsd: spdx license identifier bsd 4 clause
11 bsd-0-clause bsd: (0bsd|zero clause bsd|bsd zero clause)( license)?
12 bsd-2-clause bsd: (bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)( licen[cs]e)?
12 bsd-3-clause bsd: (bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)( licen[cs]e)?
12 bsd-4-clause bsd: (bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)( licen[cs]e)?
13 bsd-patent bsd: bsd (2 clause )?(plus )?patent( licen[cs]e)?
14 freebsd freebsd: freebsd (documentation )?licen[cs]e
16 bsd-3-clause endorse: neither the name of .{1,80} nor the names of its contributors may be used to endorse or promote products
17 bsd-4-clause advertising: all advertising materials mentioning features or use of this software must display
18 bsd redistribution: redistribution and use in source and binary forms with or without modification are permitted
20 bsd bsd: bsd (style )?licen[cs]e
22 bsd bsd: (released|licensed|distributed) under (the )?(terms of )?(the )?bsd
24 bsd redistributions: redistributions of source code must retain the above copyright notice
25 bsd redistributions: redistributions in binary form must reproduce the above copyright notice
10 mpl-2.0 mozilla: mozilla public license( version| v)? 2 0
10 mpl-1.1 mozilla: mozilla public license( version| v)? 1 1
10 mpl-1.0 mozilla: mozilla public license( version| v)? 1 0
12 mpl-2.0 mpl: (spdx license identifier )?mpl 2 0( no copyleft exception)?
12 mpl-1.1 mpl: (spdx license identifier )?mpl 1 1
14 mpl-2.0 source code form: this source code form is subject to the terms of the mozilla public license
13 mpl-2.0 mplv2: mplv2( 0)?
16 mpl mozilla: (www )?mozilla org mpl
20 mpl mozilla: mozilla public licen[cs]e
22 netscape netscape: netscape public licen[cs]e( version 1 [01])?
10 epl-1.0 eclipse: eclipse public license( version| v)? 1 0
10 epl-2.0 eclipse: eclipse public license( version| v)? 2 0
12 epl-1.0 epl: (spdx license identifier )?epl 1 0
12 epl-2.0 epl: (spdx license identifier )?epl 2 0
14 edl eclipse: eclipse distribution licen[cs]e( v 1 0)?
20 epl eclipse: eclipse public licen[cs]e
20 cpl common public: common public licen[cs]e( version 1 0)?
20 ibmpl ibm public: ibm public licen[cs]e( version 1 0)?
10 cddl-1.0 cddl: cddl 1 0
10 cddl-1.1 cddl: cddl 1 1
12 cddl common development: common development and distribution licen[cs]e( version 1 [01])?
20 cddl cddl: licensed under (the )?cddl
10 cc0-1.0 cc0: cc0( 1 0)?( universal)?
11 cc0-1.0 publicdomain: creativecommons org publicdomain zero 1 0
12 public-domain publicdomain: creativecommons org publicdomain mark 1 0
10 cc-by-nc-sa cc by: cc by nc sa( [1234] [05])?
10 cc-by-nc-nd cc by: cc by nc nd( [1234] [05])?
12 cc-by-nc cc by: cc by nc( [1234] [05])?
12 cc-by-sa cc by: cc by sa( [1234] [05])?
12 cc-by-nd cc by: cc by nd( [1234] [05])?
13 cc-by-1.0 cc by: cc by 1 0
13 cc-by-2.0 cc by: cc by 2 0
13 cc-by-2.5 cc by: cc by 2 5
13 cc-by-3.0 cc by: cc by 3 0
13 cc-by-4.0 cc by: cc by 4 0
10 cc-by-nc-sa noncommercial: creative commons attribution noncommercial share ?alike( [1234] [05])?( international| unported| generic)?( public)?( licen[cs]e)?
10 cc-by-nc-nd noncommercial: creative commons attribution noncommercial no ?deriv(ative)?s?( works)?( [1234] [05])?
12 cc-by-nc attribution non: creative commons attribution non ?commercial( [1234] [05])?( international| unported| generic)?( public)?( licen[cs]e)?
12 cc-by-nc non commercial: creative commons attribution non commercial
12 cc-by-sa creative commons: creative commons attribution share ?alike( [1234] [05])?( international| unported| generic)?( public)?( licen[cs]e)?
12 cc-by-nd creative commons: creative commons attribution no ?deriv(ative)?s?( works)?( [1234] [05])?
14 cc-by creative commons: creative commons attribution( [1234] [05])?( international| unported| generic)?( public)?( licen[cs]e)?
9 cc-by-nc-sa creativecommons: creativecommons org licenses by nc sa( [1234] [05])?
9 cc-by-nc-nd creativecommons: creativecommons org licenses by nc nd( [1234] [05])?
11 cc-by-nc creativecommons: creativecommons org licenses by nc( [1234] [05])?
11 cc-by-sa creativecommons: creativecommons org licenses by sa( [1234] [05])?
11 cc-by-nd creativecommons: creativecommons org licenses by nd( [1234] [05])?
13 cc-by creativecommons: creativecommons org licenses by( [1234] [05])?
20 cc creative commons: (licensed|released|available|published|distributed) under (a |the )?creative commons
22 cc creative commons: creative commons licen[cs]e
24 cc creative commons: creative commons legal code
26 cc-sampling sampling: creative commons sampling( plus)?( 1 0)?
10 isc isc: spdx license identifier isc
12 isc permission: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
14 isc isc: isc licen[cs]e
16 isc consortium: internet systems consortium licen[cs]e
10 zlib zlib: (spdx license identifier zlib|zlib libpng licen[cs]e|zlib licen[cs]e)
12 zlib as is: this software is provided as is without any express or implied warranty in no event will the authors be held liable
14 libpng libpng: libpng licen[cs]e( version 2)?
10 bsl-1.0 boost: boost software license( version 1 0)?
12 bsl-1.0 bsl: (spdx license identifier )?bsl 1 0
14 bsl-1.0 boost: www boost org license 1 0( txt)?
16 busl-1.1 business source: business source licen[cs]e( 1 1)?
16 busl-1.1 busl: busl 1 1
10 unlicense unlicense: (the )?unlicense
12 unlicense unencumbered: this is free and unencumbered software released into the public domain
14 unlicense unlicense: unlicense org
10 wtfpl wtfpl: wtfpl( version 2)?
12 wtfpl public license: do what the f[a-z]+ you want to public license
10 artistic-1.0 artistic: artistic license( version| v)? 1 0
10 artistic-2.0 artistic: artistic license( version| v)? 2 0
12 artistic-2.0 artistic: (spdx license identifier )?artistic 2 0
16 artistic-clarified artistic: clarified artistic licen[cs]e
20 artistic artistic: (the )?artistic licen[cs]e
22 perl perl: (same terms as|under the same license as) perl( itself)?
10 eupl-1.0 european union: european union public licen[cs]e( version| v)? 1 0
10 eupl-1.1 european union: european union public licen[cs]e( version| v)? 1 1
10 eupl-1.2 european union: european union public licen[cs]e( version| v)? 1 2
12 eupl eupl: eupl 1 [012]
20 eupl european union: european union public licen[cs]e
10 psf-2.0 python: python software foundation license( version 2)?
12 psf-2.0 psf: (spdx license identifier )?psf 2 0
14 python-2.0 python: python license( version)? 2 0
16 psf psf: psf licen[cs]e( agreement)?
10 ofl-1.0 ofl: ofl 1 0
10 ofl-1.1 ofl: ofl 1 1
12 ofl-1.1 open font: sil open font license( version 1 1)?
14 ofl ofl: scripts sil org ofl
20 ofl open font: open font licen[cs]e
10 postgresql postgresql: postgresql licen[cs]e
12 openssl openssl: openssl licen[cs]e
12 ssleay ssleay: ssleay licen[cs]e
12 ruby ruby: ruby licen[cs]e
12 php-3.0 php: php license( version)? 3 0
12 php-3.01 php: php license( version)? 3 01
14 php php: php licen[cs]e
12 zpl zope: zope public licen[cs]e( version 2 [01])?
12 vim vim: vim licen[cs]e
12 w3c w3c: w3c (software )?(notice and )?licen[cs]e
12 curl curl: curl licen[cs]e
12 json json: json licen[cs]e
13 json good not evil: shall be used for good not evil
12 beerware beer: beer ?ware( licen[cs]e)?
12 sleepycat sleepycat: sleepycat (public )?licen[cs]e
12 qpl q public: q public licen[cs]e
13 qpl q public: q public licen[cs]e( version 1 0)?
12 osl-3.0 open software: open software licen[cs]e( version| v)? 3 0
14 osl open software: open software licen[cs]e
12 afl-3.0 academic free: academic free licen[cs]e( version| v)? 3 0
14 afl academic free: academic free licen[cs]e
12 ncsa ncsa: (university of illinois )?ncsa (open source )?licen[cs]e
12 ms-pl microsoft: microsoft public licen[cs]e
12 ms-rl microsoft: microsoft reciprocal licen[cs]e
13 ms-pl ms pl: ms pl
12 apsl apple public: apple public source licen[cs]e( version 2 0)?
12 lppl latex: latex project public licen[cs]e( version 1 3c?)?
13 lppl lppl: lppl( version)? 1 [0123]c?
12 cecill cecill: cecill( [abc])?( 1 [01]| 2 [01])?( free software licen[cs]e)?
12 mulan mulan: mulan (psl|permissive software licen[cs]e)( v2)?
12 ecl-2.0 educational community: educational community licen[cs]e( version 2 0)?
12 upl-1.0 universal permissive: universal permissive licen[cs]e( version| v)?( 1 0)?
12 bcl binary code: binary code licen[cs]e agreement
12 sspl server side: server side public licen[cs]e( version 1)?
13 sspl sspl: sspl( 1 0)?
12 elastic-2.0 elastic: elastic licen[cs]e( 2 0)?
12 commons-clause commons clause: commons clause( licen[cs]e condition)?
12 polyform polyform: polyform (noncommercial|small business|shield|strict|perimeter) licen[cs]e
12 odbl-1.0 odbl: odbl( 1 0| v1 0)?
13 odbl-1.0 database licen: open (data commons )?(open )?database licen[cs]e
13 odc-by open data commons: open data commons attribution licen[cs]e
13 pddl public domain dedication: (open data commons )?public domain dedication and licen[cs]e
12 ogl open government: open government licen[cs]e( v[123]| version [123])?( 0)?
12 cdla community data: community data licen[cs]e agreement (permissive|sharing)
12 rail rail: (bigscience |creativeml )?open ?rail( m)?( licen[cs]e)?
12 llama-community llama: llama ?[0-9]? community licen[cs]e( agreement)?
12 gemma gemma: gemma terms of use
14 fair-source fair source: fair source licen[cs]e
14 free-art free art: free art licen[cs]e( 1 [23])?
14 against-drm against drm: against drm( licen[cs]e)?
14 dsl design science: design science licen[cs]e
14 opl open publication: open publication licen[cs]e
14 ogl-rpg open game: open game licen[cs]e( version 1 0a?)?
14 blueoak blue oak: blue oak model licen[cs]e( 1 0 0)?
14 hippocratic hippocratic: hippocratic licen[cs]e( [123] [01])?
30 public-domain public domain: (released|placed|dedicated|is) (in|into|to) the public domain
31 public-domain public domain: public domain (dedication|work|software)
32 public-domain no copyright: no copyright is claimed
39 proprietary under licen: under licen[cs]e from
40 proprietary all rights reserved: all rights reserved
41 proprietary proprietary: proprietary (and|or) confidential
43 proprietary unauthorized: unauthorized (copying|use|reproduction|distribution) of this
44 proprietary end user: end user licen[cs]e agreement
45 proprietary eula: subject to the eula
46 commercial commercial licen: commercial licen[cs]e (is )?(required|available)
60 dual dual licen: dual licensed under
61 see-license licen: see (the )?licen[cs]e( file)? for (more )?(details|information|terms)
62 see-license license: license file (in|at) the root
63 spdx-other spdx: spdx license identifier [0-9a-z]+( [0-9]+)*
64 copyright copyright: copyright (c )?[12][09][0-9][0-9]
66 permissive permission notice: this permission notice (shall|must) appear in all copies
"""


ANY = "\0"


def forms(regex: str) -> list[str]:
    """What ``regex`` matches, with ``ANY`` for any characters. It may have groups,
    branches, sets, dots, and parts that are optional or come again."""

    def branches(i: int) -> tuple[list[str], int]:
        found, i = parts(i)
        while i < len(regex) and regex[i] == "|":
            more, i = parts(i + 1)
            found = found + more
        return found, i

    def parts(i: int) -> tuple[list[str], int]:
        each = []
        while i < len(regex) and regex[i] not in "|)":
            c = regex[i]
            if c == "(":
                some, i = branches(i + 1)
                i += 1
            elif c == "[":
                end = regex.index("]", i)
                inside, i = regex[i + 1 : end], end + 1
                some = [ANY] if "-" in inside else list(inside)
            elif c.isalnum() or c in " .":
                some, i = [ANY if c == "." else c], i + 1
            else:
                raise ValueError(f"unknown syntax at {i} of {regex}")
            times = regex[i : i + 1]
            if times in ("?", "*", "+", "{") and times:
                i = regex.index("}", i) + 1 if times == "{" else i + 1
                some = [*some, *([] if times in "+?" else [ANY]), *([] if times == "+" else [""])]
                if times == "+" and some != [ANY]:
                    some = [*some, ANY]
            each.append(some)
        return ["".join(x) for x in product(*each)], i

    return branches(0)[0]


def keyword_words(rule: Rule) -> list[str] | None:
    """The whole words in which a match of ``rule`` has the start of its keyword; None
    if they can't be listed."""
    try:
        found = forms(rule.regex)
    except ValueError:
        return None
    words = set()
    for form in found:
        at = f" {form} ".find(rule.keyword)
        if at < 0:
            return None
        at = max(at, 1)
        words.add(f" {form} "[f" {form} ".rindex(" ", 0, at) + 1 : f" {form} ".index(" ", at)])
    return None if any(ANY in w or not w for w in words) else sorted(words)


def _read(lines: str) -> list[Rule]:
    out = []
    for line in lines.strip().splitlines():
        head, _, regex = line.partition(": ")
        priority, label, keyword = head.split(" ", 2)
        out.append(Rule(int(priority), label, keyword, regex))
    return out


RULES = BASE + _read(_RULES)
