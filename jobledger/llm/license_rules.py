"""The signature rules of the license scan, written by hand, one a line.

A line is ``label | priority | keyword | words``. Priority 1 is best: a grant or an identifier, 2 a
version or a title, 3 a mention, 4 wording that any license may have. The keyword stands in every
match as it is, word by word (its last word may go on); every keyword has one of ``ANCHORS`` in it.
In ``words``, ``word?`` is optional, and ``[..]`` and ``(a|b)`` are as in any regular expression.
"""

#: Pieces of words; a text without any of them has no keyword.
ANCHORS = (
    "licen", "gpl", "copyright", "reserved", "cc", "domain", "warrant", "spdx", "redistribut",
    "permission", "commons", "confidential", "proprietary", "attribution", "copyleft", "trademark", "patent",
)

SIGNATURES = r"""
gpl:under | 1 | general public licen | (licensed|released|distributed|available) under the? terms? of? the? gnu general public licen[cs]e
gpl:terms | 1 | general public licen | under the terms of the gnu general public licen[cs]e as published by the free software foundation
gpl:redistribute | 1 | redistribut | you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl:version | 2 | general public licen | gnu general public licen[cs]e (version|v) [0-9]+
gpl:short-version | 2 | public licen | gnu public licen[cs]e (version|v)? [0-9]+
gpl:or-later | 1 | licen | either version [0-9]+ of the licen[cs]e or at your option any later version
gpl:received | 2 | general public licen | you should have received a copy of the gnu general public licen[cs]e
gpl:name | 3 | general public licen | gnu general public licen[cs]e
gpl:only | 1 | gpl | gpl (v2|v3|2|3) 0? only
gpl:plus | 1 | gpl | gpl (v2|v3|2|3) 0? or later
gpl:v | 2 | gpl | gpl (version|v)? (v2|v3|[123]) 0?
gpl:under-short | 1 | gpl | (licensed|released|distributed|available) under the? gnu? gpl
gpl:short | 3 | gpl | gnu gpl
gpl:compatible | 3 | gpl | gpl compatible
gpl:exception | 2 | gpl | gpl with classpath exception
gpl:linking | 2 | licen | special exception to the licen[cs]e
lgpl:under | 1 | general public licen | (licensed|released|distributed|available) under the? terms? of? the? gnu? (lesser|library) general public licen[cs]e
lgpl:redistribute | 1 | redistribut | you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public licen[cs]e
lgpl:version | 2 | general public licen | (lesser|library) general public licen[cs]e (version|v) [0-9]+ [0-9]?
lgpl:received | 2 | general public licen | received a copy of the gnu (lesser|library) general public licen[cs]e
lgpl:name | 3 | general public licen | (lesser|library) general public licen[cs]e
lgpl:short | 3 | lgpl | gnu? lgpl
lgpl:v | 2 | lgpl | lgpl (v2|v3|2|3) [01]?
lgpl:plus | 1 | lgpl | lgpl (v2|v3|2|3) [01]? or later
lgpl:under-short | 1 | lgpl | (licensed|released|distributed) under the? lgpl
agpl:under | 1 | affero general public licen | (licensed|released|distributed|available) under the? terms? of? the? gnu? affero general public licen[cs]e
agpl:version | 2 | affero general public licen | affero general public licen[cs]e (version|v) [0-9]+
agpl:received | 2 | affero general public licen | received a copy of the gnu affero general public licen[cs]e
agpl:name | 3 | affero general public licen | gnu? affero general public licen[cs]e
agpl:short | 3 | agpl | gnu? agpl
agpl:v | 2 | agpl | agpl (v3|3) 0?
agpl:plus | 1 | agpl | agpl (v3|3) 0? or later
fdl:permission | 1 | permission is granted to copy | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
fdl:version | 2 | free documentation licen | free documentation licen[cs]e (version|v) [0-9]+
fdl:sections | 2 | licen | with no invariant sections no front cover texts and no back cover texts a copy of the licen[cs]e
fdl:name | 3 | free documentation licen | gnu? free documentation licen[cs]e
apache:under | 1 | licensed under the apache | licensed under the apache licen[cs]e (version|v)? [0-9]? [0-9]?
apache:released | 1 | apache licen | (released|distributed|available|published) under the apache licen[cs]e
apache:terms | 1 | apache licen | under the terms of the apache licen[cs]e
apache:except | 1 | licen | you may not use this file except in compliance with the licen[cs]e
apache:copy | 2 | copy of the licen | you may obtain a copy of the licen[cs]e at
apache:foundation | 1 | licensed to the apache | licensed to the apache software foundation
apache:agreements | 2 | licen | under one or more contributor licen[cs]e agreements
apache:version | 2 | apache licen | apache licen[cs]e (version|v) [12] [0-9]?
apache:two | 2 | apache licen | apache licen[cs]e 2 0
apache:software | 3 | apache software licen | apache software licen[cs]e
apache:name | 3 | apache licen | apache licen[cs]e
apache:basis | 2 | licen | distributed under the licen[cs]e is distributed on an as is basis
apache:governing | 2 | licen | see the licen[cs]e for the specific language governing permissions
mit:under | 1 | mit licen | (licensed|released|distributed|available|published) under (the|an|a)? mit licen[cs]e
mit:terms | 1 | mit licen | under the terms of the mit licen[cs]e
mit:title | 2 | the mit licen | the mit licen[cs]e mit
mit:file | 2 | mit licen | mit licen[cs]e see (the|licen[cs]e)
mit:name | 3 | mit licen | mit licen[cs]e
mit:licensed | 1 | mit licensed | mit licensed
mit:expat | 3 | expat licen | expat licen[cs]e
mit:x11 | 3 | x11 licen | x11 licen[cs]e
mit:x-consortium | 3 | x consortium licen | x consortium licen[cs]e
mit:grant | 1 | permission is hereby granted free | permission is hereby granted free of charge to any person obtaining a copy
mit:grant-short | 2 | permission is hereby granted free | permission is hereby granted free of charge
mit:without | 2 | without restriction including without limitation the rights to use copy modify merge publish distribute sublicen | without restriction including without limitation the rights to use copy modify merge publish distribute sublicen[cs]e
mit:notice | 2 | copyright notice and this permission | the above copyright notice and this permission notice shall be included
bsd:under | 1 | bsd licen | (licensed|released|distributed|available) under (the|a)? bsd licen[cs]e
bsd:style | 2 | bsd style licen | bsd style licen[cs]e
bsd:clause-licence | 2 | clause bsd licen | ([0234]|two|three|four) clause bsd licen[cs]e
bsd:clause-after | 2 | licen | bsd ([0234]|two|three|four) clause licen[cs]e
bsd:new | 2 | bsd licen | (new|modified|revised|simplified) bsd licen[cs]e
bsd:original | 2 | bsd licen | (original|old) bsd licen[cs]e
bsd:file | 2 | bsd style licen | governed by a bsd style licen[cs]e that can be found in the licen[cs]e file
bsd:name | 3 | bsd licen | bsd licen[cs]e
bsd:redistribution | 1 | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd:redistribution-short | 2 | redistribution and use | redistribution and use in source and binary forms
bsd:retain | 2 | redistributions of source code | redistributions of source code must retain the above copyright notice
bsd:reproduce | 2 | redistributions in binary form | redistributions in binary form must reproduce the above copyright notice
bsd:endorse | 2 | written permission | may be used to endorse or promote products derived from this software without specific prior written permission
isc:grant | 1 | permission to use copy modify and | permission to use copy modify and (or|distribute) distribute? this software for any purpose
isc:under | 1 | isc licen | (licensed|released|distributed) under the? isc licen[cs]e
isc:name | 3 | isc licen | isc licen[cs]e
mpl:subject | 1 | mozilla public licen | subject to the terms of the mozilla public licen[cs]e
mpl:under | 1 | mozilla public licen | (licensed|released|distributed) under the? mozilla public licen[cs]e
mpl:terms | 1 | mozilla public licen | under the terms of the mozilla public licen[cs]e
mpl:version | 2 | mozilla public licen | mozilla public licen[cs]e (version|v)? [0-9]+ [0-9]?
mpl:name | 3 | mozilla public licen | mozilla public licen[cs]e
epl:terms | 1 | eclipse public licen | under the terms of the eclipse public licen[cs]e
epl:under | 1 | eclipse public licen | (licensed|released|distributed|available) under the? eclipse public licen[cs]e
epl:version | 2 | eclipse public licen | eclipse public licen[cs]e (version|v)? [0-9]+ [0-9]?
epl:name | 3 | eclipse public licen | eclipse public licen[cs]e
edl:name | 3 | eclipse distribution licen | eclipse distribution licen[cs]e
cddl:under | 1 | development and distribution licen | under the terms of the common development and distribution licen[cs]e
cddl:version | 2 | development and distribution licen | common development and distribution licen[cs]e (version|v)? [0-9]+
cddl:name | 3 | development and distribution licen | common development and distribution licen[cs]e
eupl:under | 1 | union public licen | (licensed|released|distributed) under the? eupl? european union public licen[cs]e
eupl:version | 2 | union public licen | european union public licen[cs]e (version|v)? [0-9]+
eupl:name | 3 | union public licen | european union public licen[cs]e
artistic:under | 1 | artistic licen | (licensed|released|distributed) under the? artistic licen[cs]e
artistic:version | 2 | artistic licen | artistic licen[cs]e (version|v)? [0-9]+ [0-9]?
artistic:name | 3 | artistic licen | artistic licen[cs]e
zlib:name | 3 | zlib licen | zlib licen[cs]e
zlib:libpng | 2 | libpng licen | zlib libpng licen[cs]e
zlib:grant | 1 | permission is granted to anyone | permission is granted to anyone to use this software for any purpose including commercial applications
zlib:provided | 2 | warrant | provided as is without any express or implied warranty
boost:under | 1 | boost software licen | (licensed|distributed|released) under the? boost software licen[cs]e
boost:version | 2 | boost software licen | boost software licen[cs]e (version|v) [0-9]+ [0-9]?
boost:name | 3 | boost software licen | boost software licen[cs]e
unlicense:name | 3 | the unlicen | the unlicen[cs]e
unlicense:grant | 1 | released into the public domain | free and unencumbered software released into the public domain
wtfpl:name | 3 | you want to public licen | do what the fuck you want to public licen[cs]e
psf:name | 3 | python software foundation licen | python software foundation licen[cs]e
psf:under | 1 | python software foundation licen | (licensed|released|distributed) under the? python software foundation licen[cs]e
psf:short | 3 | psf licen | psf licen[cs]e
php:name | 3 | php licen | php licen[cs]e
php:version | 2 | the php licen | (version|v) [0-9]+ [0-9]+ of the php licen[cs]e
ruby:name | 3 | ruby licen | ruby licen[cs]e
ofl:under | 1 | open font licen | (licensed|released) under the? sil? open font licen[cs]e
ofl:version | 2 | open font licen | open font licen[cs]e (version|v)? [0-9]+ [0-9]?
ofl:name | 3 | open font licen | sil? open font licen[cs]e
ms-pl:name | 3 | microsoft public licen | microsoft public licen[cs]e
ms-rl:name | 3 | microsoft reciprocal licen | microsoft reciprocal licen[cs]e
cecill:name | 3 | cecill licen | cecill licen[cs]e
cecill:governed | 1 | cecill licen | governed by the cecill licen[cs]e under french law
cecill:kind | 3 | licen | cecill [abc] licen[cs]e
odbl:name | 3 | open database licen | open database licen[cs]e
odbl:under | 1 | open database licen | (licensed|available|released) under the? open database licen[cs]e
odc:by | 3 | open data commons attribution | open data commons attribution licen[cs]e
odc:pddl | 3 | public domain dedication and licen | public domain dedication and licen[cs]e
ncsa:name | 3 | open source licen | university of illinois ncsa open source licen[cs]e
ncsa:short | 3 | open source licen | ncsa open source licen[cs]e
rpl:name | 3 | reciprocal public licen | reciprocal public licen[cs]e
afl:name | 3 | academic free licen | academic free licen[cs]e
afl:under | 1 | academic free licen | licensed under the? academic free licen[cs]e
osl:name | 3 | open software licen | open software licen[cs]e
osl:under | 1 | open software licen | licensed under the? open software licen[cs]e
ibm-pl:name | 3 | ibm public licen | ibm public licen[cs]e
cpl:name | 3 | common public licen | common public licen[cs]e
cpl:attribution | 3 | common public attribution licen | common public attribution licen[cs]e
qpl:name | 3 | q public licen | q public licen[cs]e
sleepycat:name | 3 | sleepycat licen | sleepycat licen[cs]e
openssl:name | 3 | openssl licen | openssl licen[cs]e
ssleay:name | 3 | ssleay licen | ssleay licen[cs]e
postgresql:name | 3 | postgresql licen | postgresql licen[cs]e
w3c:name | 3 | licen | w3c software (notice|licen[cs]e) and? licen[cs]e
vim:name | 3 | vim licen | vim licen[cs]e
json:name | 3 | json licen | json licen[cs]e
lppl:name | 3 | project public licen | latex project public licen[cs]e
lppl:under | 1 | project public licen | under the conditions of the latex project public licen[cs]e
mulan:name | 3 | permissive software licen | mulan permissive software licen[cs]e
upl:name | 3 | universal permissive licen | universal permissive licen[cs]e
sspl:name | 3 | server side public licen | server side public licen[cs]e
busl:name | 3 | business source licen | business source licen[cs]e
elastic:name | 3 | elastic licen | elastic licen[cs]e (version|v)? 2? 0?
hippocratic:name | 3 | hippocratic licen | hippocratic licen[cs]e
beerware:name | 3 | ware licen | the beer ware licen[cs]e
rail:name | 3 | licen | (openrail|rail) m? licen[cs]e
community:name | 3 | community licen | community licen[cs]e agreement
cc:international | 2 | commons attribution | creative commons attribution [0-9] 0 international licen[cs]e?
cc:unported | 2 | commons attribution | creative commons attribution [0-9] [05] unported licen[cs]e?
cc:under | 1 | creative commons | (licensed|released|available|published) under (a|the)? creative commons attribution? licen[cs]e?
cc:work | 1 | this work is licensed under a creative commons | this work is licensed under a creative commons
cc:sharealike | 2 | commons attribution | creative commons attribution share alike
cc:sharealike-joined | 2 | commons attribution | creative commons attribution sharealike
cc:noncommercial | 2 | commons attribution | creative commons attribution (noncommercial|non) commercial?
cc:noderivs | 2 | commons attribution | creative commons attribution (noderivs|noderivatives|no) derivatives?
cc:attribution | 3 | creative commons attribution | creative commons attribution
cc:licence | 3 | commons licen | creative commons licen[cs]e
cc:by-version | 2 | cc by | cc by [1234] [05]
cc:by-sa | 2 | cc by sa | cc by sa [1234]? [05]?
cc:by-nc | 2 | cc by nc | cc by nc [1234]? [05]?
cc:by-nd | 2 | cc by nd | cc by nd [1234]? [05]?
cc:by-nc-sa | 2 | cc by nc sa | cc by nc sa [1234]? [05]?
cc:by-nc-nd | 2 | cc by nc nd | cc by nc nd [1234]? [05]?
cc:licensed | 1 | cc by | licensed under cc by
cc0:short | 3 | cc0 | cc0
cc0:version | 2 | cc0 | cc0 1 0 universal?
cc0:dedication | 1 | cc0 | cc0 1 0 universal public domain dedication
public-domain:in | 2 | public domain | (is|are|placed) in the public domain
public-domain:into | 1 | public domain | (released|placed|dedicated) (in|into|to) the public domain
public-domain:dedication | 2 | public domain dedication | public domain dedication
public-domain:mark | 2 | public domain mark | public domain mark
public-domain:name | 3 | public domain | public domain
spdx:identifier | 1 | spdx licen | spdx licen[cs]e identifier \S+
spdx:text | 2 | spdx filecopyright | spdx filecopyrighttext
copyright:years | 2 | copyright | copyright c? (19|20)[0-9][0-9] (19|20)[0-9][0-9]
copyright:year | 2 | copyright | copyright c? (19|20)[0-9][0-9]
copyright:holder-first | 2 | copyright by | copyright by \S+
copyright:reserved | 1 | all rights reserved | copyright c? [0-9]+ \S+ \S+? all rights reserved
copyright:foundation | 2 | copyright | copyright c? [0-9]+ [0-9]? free software foundation
copyright:notice | 4 | copyright notice | copyright notice
copyright:holders | 4 | copyright holder | copyright (holder|holders)
copyright:infringement | 4 | copyright infring | copyright infringement
copyright:law | 4 | copyright law | copyright (law|laws)
copyright:protected | 3 | protected by copyright | protected by copyright
reserved:some | 2 | some rights reserved | some rights reserved
reserved:no | 2 | no rights reserved | no rights reserved
warranty:none | 3 | without any warranty | without any warranty
warranty:even | 3 | warranty of merchantability | without even the implied warranty of merchantability
warranty:as-is | 2 | without warrant | provided as is without warranty of any kind
warranty:as-is-capital | 3 | without warrant | as is without warrant(y|ies)
warranty:fitness | 3 | warranties of merchantability | implied warranties of merchantability and fitness for a particular purpose
warranty:disclaimer | 4 | disclaimer of warrant | disclaimer of warrant(y|ies)
warranty:no | 4 | no warrant | no warrant(y|ies)
proprietary:confidential | 3 | confidential and proprietary | confidential and proprietary
proprietary:trade | 3 | proprietary and confidential | proprietary and confidential
proprietary:software | 4 | proprietary software | proprietary software
proprietary:licence | 3 | proprietary licen | proprietary licen[cs]e
proprietary:copying | 2 | prior written permission | may not be (copied|reproduced|redistributed) without prior written permission
proprietary:unauthorized | 2 | strictly prohibited proprietary | unauthorized copying of this file via any medium is strictly prohibited proprietary and confidential
proprietary:no-part | 2 | permission | no part of this (publication|book|document|work) may be reproduced without permission
proprietary:eula | 3 | user licen | end user licen[cs]e agreement
trademark:registered | 4 | registered trademark | registered (trademark|trademarks)
trademark:of | 4 | trademark | (trademark|trademarks) of their respective owners
patent:grant | 3 | patent licen | patent licen[cs]e
patent:pending | 4 | patent pending | patent pending
dual:licensed | 2 | dual licensed | dual licensed under
generic:copyleft | 4 | copyleft | copyleft
generic:see | 4 | licen | see (the)? licen[cs]e file? for (more|details|information)
generic:same | 3 | under the same licen | under the same licen[cs]e
generic:terms | 4 | terms of the licen | under the terms of the licen[cs]e
generic:grants | 3 | licen | hereby grants you a (worldwide|perpetual|limited|personal)? licen[cs]e
generic:open | 4 | open source licen | open source licen[cs]e
generic:free | 4 | free software licen | free software licen[cs]e
generic:agreement | 4 | licen | licen[cs]e agreement
generic:use | 4 | licensed for | licensed for (personal|commercial|educational|non) use?
generic:under | 4 | licensed under | licensed under
generic:permission | 4 | with permission | (reprinted|reproduced|used) with permission
"""


def lines() -> list[list[str]]:
    """(label, priority, keyword, words) of every signature, in order."""
    return [[part.strip() for part in line.split(" | ")] for line in SIGNATURES.strip().splitlines()]
