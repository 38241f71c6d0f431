"""Signature rules of the license scan, over lower-cased words joined by single blanks.

NAMES: label; SPDX words; the license's names as a pattern; its addresses; a
sentence that its text or notice alone has.  TEXTS: further sentences of license
texts and notices.  LOOSE: rules without a license of their own.  Every filled field
of NAMES and every line of the others is a signature of its own (written()); names
also come after "licensed under", and alternatives are compiled one by one, each
with its gate, which makes more compiled rules than signatures.
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: label | SPDX identifier in words | names | address words | sentence of its own ("" where it has none)
NAMES = r"""
apache-2.0 | apache 2 0 | apache (software )?licen[sc]e (version 2 0|v2( 0)?|2 0)|apache 2( 0)? licen[sc]e | apache org licenses license 2 0 | you may not use this file except in compliance with the license
apache-1.1 | apache 1 1 | apache (software )?licen[sc]e (version 1 1|v1 1|1 1) | apache org licenses license 1 1 | this product includes software developed by the apache software foundation
apache-1.0 | apache 1 0 | apache (software )?licen[sc]e (version 1 0|v1 0|1 0) | apache org licenses license 1 0 | this product includes software developed by the apache group
mit | mit | (the )?mit licen[sc]e|(the )?expat licen[sc]e | opensource org licenses? mit | permission is hereby granted free of charge to any person obtaining a copy of this software
mit-0 | mit 0 | mit no attribution( licen[sc]e)?|mit 0 licen[sc]e | opensource org licenses? mit 0 |
bsd-2-clause | bsd 2 clause | (simplified|freebsd|2 clause|two clause) bsd licen[sc]e|bsd 2 clause( licen[sc]e)? | opensource org licenses? bsd 2 clause |
bsd-3-clause | bsd 3 clause | (new|revised|modified|3 clause|three clause) bsd licen[sc]e|bsd 3 clause( licen[sc]e)? | opensource org licenses? bsd 3 clause | neither the name of (the )?([^ ]+ ){1,8}nor the names of its contributors may be used to endorse
bsd-4-clause | bsd 4 clause | (original|old|4 clause|four clause) bsd licen[sc]e|bsd 4 clause( licen[sc]e)? | opensource org licenses? bsd 4 clause | all advertising materials mentioning features or use of this software must display
bsd-1-clause | bsd 1 clause | (1 clause|one clause) bsd licen[sc]e|bsd 1 clause( licen[sc]e)? | opensource org licenses? bsd 1 clause |
0bsd | 0bsd | (zero clause|0 clause) bsd( licen[sc]e)?|bsd zero clause( licen[sc]e)? | opensource org licenses? 0bsd | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software
gpl-1.0 | gpl 1 0( only| or later)? | gnu general public licen[sc]e (version 1( 0)?|v1)|gpl ?v?1( 0)? | gnu org licenses gpl 1 0 |
gpl-2.0 | gpl 2 0( only| or later)? | gnu general public licen[sc]e (version 2( 0)?|v2)|gpl ?v?2( 0)? | gnu org licenses gpl 2 0 | either version 2 of the license or at your option any later version
gpl-3.0 | gpl 3 0( only| or later)? | gnu general public licen[sc]e (version 3( 0)?|v3)|gpl ?v?3( 0)? | gnu org licenses gpl 3 0 | either version 3 of the license or at your option any later version
lgpl-2.0 | lgpl 2 0( only| or later)? | gnu (library|lesser) general public licen[sc]e (version 2( 0)?|v2)|lgpl ?v?2( 0)? | gnu org licenses lgpl 2 0 |
lgpl-2.1 | lgpl 2 1( only| or later)? | gnu lesser general public licen[sc]e (version 2 1|v2 1)|lgpl ?v?2 1 | gnu org licenses lgpl 2 1 |
lgpl-3.0 | lgpl 3 0( only| or later)? | gnu lesser general public licen[sc]e (version 3( 0)?|v3)|lgpl ?v?3( 0)? | gnu org licenses lgpl 3 0 |
agpl-1.0 | agpl 1 0( only| or later)? | affero general public licen[sc]e (version 1( 0)?|v1)|agpl ?v?1( 0)? | affero org oagpl |
agpl-3.0 | agpl 3 0( only| or later)? | (gnu )?affero general public licen[sc]e (version 3( 0)?|v3)|agpl ?v?3( 0)? | gnu org licenses agpl 3 0 | interacting with it remotely through a computer network
gfdl-1.1 | gfdl 1 1( only| or later)? | gnu free documentation licen[sc]e (version 1 1|v1 1)|gfdl ?v?1 1 | gnu org licenses fdl 1 1 |
gfdl-1.2 | gfdl 1 2( only| or later)? | gnu free documentation licen[sc]e (version 1 2|v1 2)|gfdl ?v?1 2 | gnu org licenses fdl 1 2 |
gfdl-1.3 | gfdl 1 3( only| or later)? | gnu free documentation licen[sc]e (version 1 3|v1 3)|gfdl ?v?1 3 | gnu org licenses fdl 1 3 |
mpl-1.0 | mpl 1 0 | mozilla public licen[sc]e (version 1 0|v1 0|1 0)|mpl ?v?1 0 | mozilla org mpl 1 0 |
mpl-1.1 | mpl 1 1 | mozilla public licen[sc]e (version 1 1|v1 1|1 1)|mpl ?v?1 1 | mozilla org mpl 1 1 |
mpl-2.0 | mpl 2 0 | mozilla public licen[sc]e (version 2 0|v ?2 0|2 0)|mpl ?v?2( 0)? | mozilla org mpl 2 0 | this source code form is subject to the terms of the mozilla public license v 2 0
epl-1.0 | epl 1 0 | eclipse public licen[sc]e (version 1 0|v ?1( 0)?|1 0)|epl ?v?1 0 | eclipse org legal epl v10 |
epl-2.0 | epl 2 0 | eclipse public licen[sc]e (version 2 0|v ?2( 0)?|2 0)|epl ?v?2 0 | eclipse org legal epl (2 0|v20) |
edl-1.0 | edl 1 0 | eclipse distribution licen[sc]e (version 1 0|v ?1( 0)?|1 0) | eclipse org org documents edl v10 |
cddl-1.0 | cddl 1 0 | common development and distribution licen[sc]e (version 1 0|1 0)|cddl ?v?1 0 | opensource org licenses? cddl 1 0 |
cddl-1.1 | cddl 1 1 | common development and distribution licen[sc]e (version 1 1|1 1)|cddl ?v?1 1 | opensource org licenses? cddl 1 1 |
cpl-1.0 | cpl 1 0 | common public licen[sc]e (version 1 0|1 0) | opensource org licenses? cpl 1 0 |
eupl-1.1 | eupl 1 1 | european union public licen[sc]e (version 1 1|v ?1 1|1 1)|eupl ?v?1 1 | joinup ec europa eu eupl 1 1 |
eupl-1.2 | eupl 1 2 | european union public licen[sc]e (version 1 2|v ?1 2|1 2)|eupl ?v?1 2 | joinup ec europa eu eupl 1 2 |
cecill-2.1 | cecill 2 1 | cecill( free software)? licen[sc]e( agreement)? (version 2 1|2 1) | cecill info licences licence cecill v2 1 |
artistic-1.0 | artistic 1 0 | artistic licen[sc]e (version 1 0|1 0) | opensource org licenses? artistic 1 0 |
artistic-2.0 | artistic 2 0 | artistic licen[sc]e (version 2 0|2 0) | opensource org licenses? artistic 2 0 |
bsl-1.0 | bsl 1 0 | boost software licen[sc]e( version 1 0| 1 0)? | boost org license 1 0 txt | boost software license version 1 0 august 17th 2003
busl-1.1 | busl 1 1 | business source licen[sc]e( version 1 1| 1 1)? | mariadb com bsl11 |
isc | isc | (the )?isc licen[sc]e | opensource org licenses? isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided
zlib | zlib | zlib( libpng)? licen[sc]e | opensource org licenses? zlib | altered source versions must be plainly marked as such
unlicense | unlicense | (the )?unlicense( licen[sc]e)? | unlicense org | this is free and unencumbered software released into the public domain
wtfpl | wtfpl | wtfpl|do what the fuck you want to public licen[sc]e | wtfpl net | 
cc0-1.0 | cc0 1 0 | cc0( 1 0)?( universal)?( licen[sc]e)?|creative commons zero( 1 0| v1 0)? | creativecommons org publicdomain zero 1 0 | has dedicated the work to the public domain by waiving
cc-by-1.0 | cc by 1 0 | cc by 1 0|creative commons attribution 1 0( [a-z]+)? | creativecommons org licenses by 1 0 |
cc-by-2.0 | cc by 2 0 | cc by 2 0|creative commons attribution 2 0( [a-z]+)? | creativecommons org licenses by 2 0 |
cc-by-2.5 | cc by 2 5 | cc by 2 5|creative commons attribution 2 5( [a-z]+)? | creativecommons org licenses by 2 5 |
cc-by-3.0 | cc by 3 0 | cc by 3 0|creative commons attribution 3 0( [a-z]+)? | creativecommons org licenses by 3 0 |
cc-by-4.0 | cc by 4 0 | cc by 4 0|creative commons attribution 4 0( international)? | creativecommons org licenses by 4 0 | 
cc-by-sa-2.0 | cc by sa 2 0 | cc by sa 2 0|creative commons attribution share ?alike 2 0 | creativecommons org licenses by sa 2 0 |
cc-by-sa-3.0 | cc by sa 3 0 | cc by sa 3 0|creative commons attribution share ?alike 3 0 | creativecommons org licenses by sa 3 0 |
cc-by-sa-4.0 | cc by sa 4 0 | cc by sa 4 0|creative commons attribution share ?alike 4 0 | creativecommons org licenses by sa 4 0 |
cc-by-nc-3.0 | cc by nc 3 0 | cc by nc 3 0|creative commons attribution non ?commercial 3 0 | creativecommons org licenses by nc 3 0 |
cc-by-nc-4.0 | cc by nc 4 0 | cc by nc 4 0|creative commons attribution non ?commercial 4 0 | creativecommons org licenses by nc 4 0 |
cc-by-nd-3.0 | cc by nd 3 0 | cc by nd 3 0|creative commons attribution no ?deriv(ative)?s 3 0 | creativecommons org licenses by nd 3 0 |
cc-by-nd-4.0 | cc by nd 4 0 | cc by nd 4 0|creative commons attribution no ?deriv(ative)?s 4 0 | creativecommons org licenses by nd 4 0 |
cc-by-nc-sa-3.0 | cc by nc sa 3 0 | cc by nc sa 3 0|creative commons attribution non ?commercial share ?alike 3 0 | creativecommons org licenses by nc sa 3 0 |
cc-by-nc-sa-4.0 | cc by nc sa 4 0 | cc by nc sa 4 0|creative commons attribution non ?commercial share ?alike 4 0 | creativecommons org licenses by nc sa 4 0 |
cc-by-nc-nd-3.0 | cc by nc nd 3 0 | cc by nc nd 3 0|creative commons attribution non ?commercial no ?deriv(ative)?s 3 0 | creativecommons org licenses by nc nd 3 0 |
cc-by-nc-nd-4.0 | cc by nc nd 4 0 | cc by nc nd 4 0|creative commons attribution non ?commercial no ?deriv(ative)?s 4 0 | creativecommons org licenses by nc nd 4 0 |
odbl-1.0 | odbl 1 0 | open (data commons open )?database licen[sc]e( version 1 0| 1 0)?|odbl( 1 0)? | opendatacommons org licenses odbl |
odc-by-1.0 | odc by 1 0 | open data commons attribution licen[sc]e( 1 0)?|odc by( 1 0)? | opendatacommons org licenses by |
pddl-1.0 | pddl 1 0 | public domain dedication and licen[sc]e( 1 0)?|pddl( 1 0)? | opendatacommons org licenses pddl |
ogl-uk-3.0 | ogl uk 3 0 | open government licen[sc]e (version 3 0|v3( 0)?|3 0) | nationalarchives gov uk doc open government licence version 3 |
python-2.0 | python 2 0 | python software foundation licen[sc]e( version 2| 2 0)?|psf licen[sc]e( version 2)? | docs python org license |
postgresql | postgresql | postgresql licen[sc]e | opensource org licenses? postgresql |
php-3.01 | php 3 01 | php licen[sc]e( version 3 01| 3 01)? | php net license 3 01 |
ruby | ruby | ruby licen[sc]e|the ruby language licen[sc]e | ruby lang org en about license |
ofl-1.1 | ofl 1 1 | sil open font licen[sc]e( version 1 1| 1 1)? | scripts sil org ofl |
ms-pl | ms pl | microsoft public licen[sc]e | opensource org licenses? ms pl |
ms-rl | ms rl | microsoft reciprocal licen[sc]e | opensource org licenses? ms rl |
upl-1.0 | upl 1 0 | universal permissive licen[sc]e( version 1 0| v ?1 0| 1 0)? | opensource org licenses? upl |
afl-3.0 | afl 3 0 | academic free licen[sc]e( version 3 0| 3 0)? | opensource org licenses? afl 3 0 |
osl-3.0 | osl 3 0 | open software licen[sc]e( version 3 0| 3 0)? | opensource org licenses? osl 3 0 |
ncsa | ncsa | (university of illinois )?ncsa open source licen[sc]e | opensource org licenses? ncsa |
sspl-1.0 | sspl 1 0 | server side public licen[sc]e( version 1| v1)? | mongodb com licensing server side public license |
elastic-2.0 | elastic 2 0 | elastic licen[sc]e( version 2( 0)?| 2 0) | elastic co licensing elastic license |
blueoak-1.0.0 | blueoak 1 0 0 | blue oak model licen[sc]e( 1 0 0)? | blueoakcouncil org license 1 0 0 |
openssl | openssl | openssl licen[sc]e | openssl org source license |
vim | vim | vim licen[sc]e | vimhelp org uganda |
curl | curl | curl licen[sc]e | curl se docs copyright |
x11 | x11 | (the )?x11 licen[sc]e | opensource org licenses? x11 |
lppl-1.3c | lppl 1 3c | latex project public licen[sc]e( version 1 3c?| 1 3c?)? | latex project org lppl |
"""

#: label | sentence, as a pattern: what only this license's text or usual notice says.
TEXTS = r"""
apache-2.0 | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 | licensed to the apache software foundation asf under one or more contributor license agreements
apache-2.0 | grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works
apache-1.1 | products derived from this software may not be called apache nor may apache appear in their name
mit | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
mit | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
bsd | redistribution and use in source and binary forms with or without modification are permitted provided that
bsd | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | redistributions in binary form must reproduce the above copyright notice this list of conditions
bsd | in no event shall the (copyright holder|copyright owner|author|regents)s?( or contributors)? be liable for any direct indirect incidental special exemplary
bsd-3-clause | neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | this product includes software developed by the university of california berkeley and its contributors
gpl | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl | this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty
gpl | you should have received a copy of the gnu general public license along with this program
gpl | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
gpl-2.0 | the licenses for most software are designed to take away your freedom to share and change it
gpl-2.0 | 51 franklin street fifth floor boston
gpl-3.0 | the gnu general public license is a free copyleft license for software and other kinds of works
lgpl | this library is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license
lgpl | you should have received a copy of the gnu lesser general public license along with this
lgpl-3.0 | this version of the gnu lesser general public license incorporates the terms and conditions of version 3
agpl-3.0 | the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation
agpl | you should have received a copy of the gnu affero general public license along with this program
gfdl-1.3 | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3
gfdl-1.2 | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 2
gfdl-1.1 | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 1
mpl-1.1 | the contents of this file are subject to the mozilla public license version 1 1
mpl-2.0 | if a copy of the mpl was not distributed with this file you can obtain one at
epl-1.0 | the accompanying program is provided under the terms of this eclipse public license agreement
epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
epl-1.0 | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
edl-1.0 | this program and the accompanying materials are made available under the terms of the eclipse distribution license v 1 0
cddl-1.0 | the contents of this file are subject to the terms of the common development and distribution license
cpl-1.0 | the accompanying program is provided under the terms of this common public license agreement
eupl-1.2 | licensed under the eupl version 1 2 or as soon they will be approved by the european commission
eupl-1.1 | licensed under the eupl version 1 1 or as soon they will be approved by the european commission
cecill-2.1 | this software is governed by the cecill license under french law and abiding by the rules of distribution of free software
artistic-1.0 | the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control
artistic-2.0 | this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed
bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
busl-1.1 | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
isc | the software is provided as is and (the author|isc|internet systems consortium) disclaims all warranties with regard to this software
zlib | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | the origin of this software must not be misrepresented you must not claim that you wrote the original software
unlicense | anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary
unlicense | we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors
wtfpl | everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
cc0-1.0 | to the extent possible under law ([^ ]+ ){1,8}has waived all copyright and related or neighboring rights
cc-by-4.0 | this work is licensed under a creative commons attribution 4 0 international license
cc-by-3.0 | this work is licensed under a creative commons attribution 3 0 (unported|[a-z]+) license
cc-by-sa-4.0 | this work is licensed under a creative commons attribution sharealike 4 0 international license
cc-by-sa-3.0 | text is available under the creative commons attribution share ?alike license
cc-by-nc-4.0 | this work is licensed under a creative commons attribution non ?commercial 4 0 international license
cc-by-nc-nd-4.0 | this is an open access article under the cc by nc nd license
cc-by-4.0 | this is an open access article (under|distributed under) the (terms of the )?(cc by|creative commons attribution) license
cc-by-nc-sa-4.0 | this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license
odbl-1.0 | this database is made available under the open database license
odbl-1.0 | any rights in individual contents of the database are licensed under the database contents license
pddl-1.0 | this data is made available under the public domain dedication and license
ogl-uk-3.0 | contains public sector information licensed under the open government licence v3 0
python-2.0 | this license agreement is between the python software foundation psf and the individual or organization licensee
postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
php-3.01 | this product includes php software freely available from
ruby | you can redistribute it and or modify it under either the terms of the 2 clause bsdl
ofl-1.1 | this font software is licensed under the sil open font license
ofl-1.1 | the fonts and derivatives however cannot be released under any other type of license
ms-pl | if you distribute any portion of the software in source code form you may do so only under this license by including a complete copy
upl-1.0 | to any person obtaining a copy of this software associated documentation and or data collectively the software
afl-3.0 | licensed under the academic free license version 3 0
osl-3.0 | licensed under the open software license version 3 0
ncsa | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal with the software without restriction
sspl-1.0 | if you make the functionality of the program or a modified version available to third parties as a service
elastic-2.0 | you may not provide the software to third parties as a hosted or managed service
blueoak-1.0.0 | this license gives everyone as much permission to work with this software as possible
openssl | this product includes software developed by the openssl project for use in the openssl toolkit
openssl | this product includes cryptographic software written by eric young
x11 | except as contained in this notice the name of the x consortium shall not be used in advertising
curl | except as contained in this notice the name of a copyright holder shall not be used in advertising or otherwise to promote the sale
vim | vim is charityware you can use and copy it as much as you like
lppl-1.3c | this work may be distributed and or modified under the conditions of the latex project public license
proprietary | (no part of this (publication|work|document|book)) may be reproduced (stored|distributed|or transmitted)
proprietary | this software is the confidential and proprietary information of
proprietary | for internal use only do not distribute
proprietary | you may not copy modify distribute sell or lease any part of (our|the) (services|software)
public-domain | (this|the) (work|file|software|text) (is|has been) (placed |released )?(in|into) the public domain
public-domain | this work is in the public domain in the united states because
no-warranty | use (it |this software )?at your own risk
"""

#: Rules without a license of their own: label, priority, confidence, pattern.
LOOSE = (
    ("gpl", 30, 0.7, r"(gnu )?general public licen[sc]e|gnu gpl"),
    ("lgpl", 35, 0.7, r"(gnu )?(lesser|library) general public licen[sc]e|gnu lgpl"),
    ("agpl", 35, 0.7, r"(gnu )?affero general public licen[sc]e|gnu agpl"),
    ("apache", 30, 0.6, r"apache( software)? licen[sc]e"),
    ("mozilla", 30, 0.6, r"mozilla public licen[sc]e"),
    ("bsd", 30, 0.6, r"bsd( style| like)? licen[sc]e"),
    ("creative-commons", 25, 0.6, r"creative commons( licen[sc]e)?"),
    ("cc-by", 28, 0.7, r"cc by"),
    ("cc-by-sa", 32, 0.7, r"cc by sa"),
    ("cc-by-nc", 32, 0.7, r"cc by nc"),
    ("cc-by-nd", 32, 0.7, r"cc by nd"),
    ("cc-by-nc-sa", 34, 0.7, r"cc by nc sa"),
    ("cc-by-nc-nd", 34, 0.7, r"cc by nc nd"),
    ("public-domain", 25, 0.5, r"(in|into|to|under) the public domain|public domain (work|dedication|mark)"),
    ("reserved", 40, 0.9, r"all rights reserved"),
    ("reserved", 35, 0.8, r"tous droits réservés|alle rechte vorbehalten|todos los derechos reservados"),
    ("copyright", 15, 0.4, r"copyright (c )?(19|20)[0-9][0-9]"),
    ("no-warranty", 15, 0.4, r"without (any )?warrant(y|ies)( of any kind)?|as is without warranty"),
    ("proprietary", 30, 0.8, r"proprietary and confidential|unauthorised (copying|reproduction|distribution)|unauthorized (copying|reproduction|distribution)"),
    ("licensed", 5, 0.2, r"(dual )?licensed under"),
    ("licensed", 5, 0.2, r"unter (der )?lizenz|sous (la )?licence|bajo (la )?licencia"),
)

class Rule(NamedTuple):
    name: str
    label: str
    priority: int
    confidence: float
    gate: tuple[str, ...]
    pattern: re.Pattern


def _alternatives(pattern: str) -> list[str]:
    """The alternatives at the top level; one with an optional blank and v ("gpl ?v?2") gives each way of writing."""
    out, depth = [""], 0
    for c in pattern:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.replace(" ?v?", way) for x in out for way in ((" ", " v", "v", "") if " ?v?" in x else ("",))]


def _gate(pattern: str) -> tuple[str, ...]:
    """Words of which every match holds one: the longest word of each top-level alternative that nothing makes optional."""
    out: list[str] = []
    for p in _alternatives(pattern):
        while re.search(r"\([^()]*\)", p):
            p = re.sub(r"\([^()]*\)[?*+]?(\{[^}]*\})?", " ", p)
        p = re.sub(r"[^ ]+ \?[^ ]+|[^ ]*[^ ]\?[^ ]*", " ", p)
        words = [w for w in p.split(" ") if re.fullmatch(r"\w+|licen\[sc\]es?", w)]
        best = max(words, key=len)
        out += [best.replace("[sc]", "s"), best.replace("[sc]", "c")] if "[" in best else [best]
    return tuple(dict.fromkeys(out))


def rules() -> tuple[Rule, ...]:
    made = []

    def add(name, label, priority, confidence, pattern):
        for p in _alternatives(pattern):
            made.append(Rule(name, label, priority, confidence, _gate(p), re.compile(f"(?<![^ ])(?:{p})(?![^ ])")))

    for line in NAMES.strip().splitlines():
        label, spdx, names, address, own = [*re.split(r"\s\|(?:\s|$)", line), ""][:5]
        label, spdx, names, address, own = (x.strip() for x in (label, spdx, names, address, own))
        add(f"{label}/spdx", label, 100, 1.0, f"spdx licen[sc]e identifier {spdx}")
        for name in _alternatives(names):
            add(f"{label}/grant", label, 90, 0.95, f"licensed under (?:the |a |an )?(?:terms of (?:the )?)?{name}")
            add(f"{label}/name", label, 60, 0.8, name)
        add(f"{label}/address", label, 80, 0.9, address)
        if own:
            add(f"{label}/text", label, 85, 0.95, own)
    for label, pattern in _texts():
        add(f"{label}/text", label, 85, 0.95, pattern)
    for label, priority, confidence, pattern in LOOSE:
        add(f"{label}/loose", label, priority, confidence, pattern)
    return tuple(made)


def _texts() -> list[tuple[str, str]]:
    return [tuple(x.strip() for x in line.split(" | ")) for line in TEXTS.strip().splitlines()]


def written() -> int:
    """Signatures as they are written above: filled fields and lines, alternatives and templates not counted."""
    fields = sum(bool(x.strip()) for line in NAMES.strip().splitlines() for x in re.split(r"\s\|(?:\s|$)", line)[1:])
    return fields + len(_texts()) + len(LOOSE)
