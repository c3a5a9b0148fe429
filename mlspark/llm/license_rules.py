"""Signature rules of licences: fixed values.

Patterns are matched against the words of a text in lower case, one blank apart, and begin and end at words.
A line holds a label, the words that must all be in the text before the pattern is tried, and the pattern.
"""

from __future__ import annotations

# passages of licence texts and headers
NOTICES = r"""
mit; permission charge documentation; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit; copies substantial portions; the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit; merchantability noninfringement; the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
mit-0; permission charge; permission is hereby granted free of charge to any person obtaining a copy of this software .{40,400}?to permit persons to whom the software is furnished to do so the software is provided as is
mit-modern-variant; permission agreement royalty; permission is hereby granted without written agreement and without license or royalty fees to use copy modify and distribute
x11; advertising consortium; except as contained in this notice the name of the x consortium shall not be used in advertising
isc; permission purpose fee; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
0bsd; permission purpose fee; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
bsd; redistribution forms; redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd; redistributions retain; redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd; redistributions reproduce; redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause; endorse promote; neither the name of .{1,120}? (?:nor|and) (?:the names of )?(?:its|their|any|other) .{0,40}?contributors? may be used to endorse or promote products derived from this software
bsd-3-clause; endorse promote; the name of the author may not be used to endorse or promote products
bsd-4-clause; advertising materials; all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-3-clause-clear; express implied patent; no express or implied licenses to any party s patent rights are granted by this license
bsd-2-clause-patent; perpetual contributor; subject to the terms and conditions of this license each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual
apache-2.0; apache compliance; licensed under the apache license version 2 0 the license you may not use this (?:file|work|software) except in compliance with the license
apache-2.0; apache licensed; licensed under the apache license version 2 0
apache-2.0; apache foundation; licensed to the apache software foundation asf under one or more contributor license agreements
apache-2.0; january apache; apache license version 2 0 january 2004
apache-1.1; apache product; this product includes software developed by the apache (?:software foundation|group)
gpl-1.0; gnu published; gnu general public license as published by the free software foundation (?:either )?version 1
gpl-2.0; gnu published; gnu general public license (?:version 2 )?as published by the free software foundation (?:either )?version 2(?! or later| of the license or)
gpl-2.0-or-later; gnu published later; gnu general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
gpl-3.0; gnu published; gnu general public license (?:version 3 )?as published by the free software foundation (?:either )?version 3(?! or later| of the license or)
gpl-3.0-or-later; gnu published later; gnu general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
gpl; verbatim gnu; gnu general public license .{0,80}?everyone is permitted to copy and distribute verbatim copies of this license document
lgpl-2.0; library published; gnu library general public license as published by the free software foundation (?:either )?version 2
lgpl-2.1; lesser published; gnu lesser general public license (?:version 2 1 )?as published by the free software foundation (?:either )?version 2 1(?! of the license or)
lgpl-2.1-or-later; lesser published later; gnu lesser general public license as published by the free software foundation either version 2 1 of the license or (?:at your option )?any later version
lgpl-3.0; lesser published; gnu lesser general public license (?:version 3 )?as published by the free software foundation (?:either )?version 3(?! of the license or)
lgpl-3.0-or-later; lesser published later; gnu lesser general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
agpl-3.0; affero published; gnu affero general public license (?:version 3 )?as published by the free software foundation (?:either )?version 3
gfdl; documentation permission; permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-1.1; mozilla contents; the contents of this file are subject to the mozilla public license version 1 1
mpl-2.0; mozilla source; this source code form is subject to the terms of the mozilla public license v 2 0
epl-1.0; eclipse available; made available under the terms of the eclipse public license v1 0
epl-2.0; eclipse available; made available under the terms of the eclipse public license (?:v ?)?2 0
cddl-1.0; contents distribution; the contents of this file are subject to the terms of the common development and distribution license
ms-pl; governs accompanying; this license governs use of the accompanying software if you use the software you accept this license
zlib; claim misrepresented; the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib; altered plainly; altered source versions must be plainly marked as such and must not be misrepresented as being the original software
bsl-1.0; machine executable; unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor
unlicense; unencumbered; this is free and unencumbered software released into the public domain
wtfpl; fuck want; you just do what the fuck you want to
cc0-1.0; waived neighboring; to the extent possible under law .{1,120}? has waived all copyright and related or neighboring rights
cc-by-4.0; creative attribution; creative commons attribution 4 0 international public license
ofl-1.1; font sil; this font software is licensed under the sil open font license version 1 1
artistic-2.0; verbatim preamble; everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed .{0,40}?preamble this license establishes the terms
python-2.0; python psf; this license agreement is between the python software foundation psf and the individual or organization
php-3.01; php product; this product includes php software freely available from
openssl; openssl toolkit; this product includes software developed by the openssl project for use in the openssl toolkit
ssleay; cryptographic eric; this product includes cryptographic software written by eric young
curl; permission appear; permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
ncsa; neither names endorse; neither the names of .{1,120}? nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission
icu; unicode permission; permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
proprietary; rights reserved confidential; confidential and proprietary .{0,80}?all rights reserved
proprietary; unauthorized copying prohibited; unauthorized copying of this file via any medium is strictly prohibited
public-domain; public domain; (?:this|the) (?:work|file|code|software|document) (?:is|has been) (?:hereby )?(?:placed|released|dedicated) (?:in|into|to) the public domain
"""

# addresses of licence texts, as their words
URLS = r"""
mit; opensource licenses; opensource org licenses mit(?: license)?
mit; choosealicense licenses; choosealicense com licenses mit
mit; wikipedia mit; wikipedia org wiki mit license
apache-2.0; apache licenses; apache org licenses license 2 0
apache-1.1; apache licenses; apache org licenses license 1 1
apache-1.0; apache licenses; apache org licenses license 1 0
apache-2.0; opensource licenses; opensource org licenses apache 2 0
apache-2.0; choosealicense licenses; choosealicense com licenses apache 2 0
gpl; gnu org; gnu org (?:licenses|copyleft) gpl
gpl-1.0; gnu licenses; gnu org licenses (?:old licenses )?gpl 1 0
gpl-2.0; gnu licenses; gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0; gnu licenses; gnu org licenses gpl 3 0
lgpl; gnu org; gnu org (?:licenses|copyleft) lgpl
lgpl-2.1; gnu licenses; gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3.0; gnu licenses; gnu org licenses lgpl 3 0
agpl-3.0; gnu licenses; gnu org licenses agpl(?: 3 0)?
gfdl; gnu org; gnu org (?:licenses|copyleft) fdl
gpl-2.0; opensource licenses; opensource org licenses gpl 2 0
gpl-3.0; opensource licenses; opensource org licenses gpl 3 0
bsd-2-clause; opensource licenses; opensource org licenses bsd 2 clause
bsd-3-clause; opensource licenses; opensource org licenses bsd 3 clause
bsd; opensource licenses; opensource org licenses bsd license
isc; opensource licenses; opensource org licenses isc
zlib; opensource licenses; opensource org licenses zlib
zlib; zlib net; zlib net zlib license
artistic-2.0; opensource licenses; opensource org licenses artistic license 2 0
mpl-1.1; mozilla mpl; mozilla org mpl mpl 1 1
mpl-2.0; mozilla mpl; mozilla org (?:en us )?mpl 2 0
epl-1.0; eclipse org; eclipse org (?:org documents|legal) epl v10
epl-2.0; eclipse org; eclipse org (?:org documents |legal )?(?:legal )?epl(?: 2 0| v20)
bsl-1.0; boost license; boost org license 1 0
unlicense; unlicense org; unlicense org
wtfpl; wtfpl net; wtfpl net
cddl-1.0; opensource licenses; opensource org licenses cddl(?: 1 0| license)?
ofl-1.1; sil ofl; scripts sil org ofl
python-2.0; python license; docs python org (?:3 )?license
eupl-1.2; eupl joinup; joinup ec europa eu .{0,60}?eupl
odbl-1.0; opendatacommons odbl; opendatacommons org licenses odbl
odc-by-1.0; opendatacommons licenses; opendatacommons org licenses by
pddl-1.0; opendatacommons pddl; opendatacommons org licenses pddl
cc0-1.0; creativecommons zero; creativecommons org publicdomain zero 1 0
public-domain; creativecommons mark; creativecommons org publicdomain mark 1 0
"""

# names with a version, then names alone
VERSIONS = r"""
apache-1.0; apache; apache (?:software )?(?:licen[cs]e )?(?:v|version )?1 0
apache-1.1; apache; apache (?:software )?(?:licen[cs]e )?(?:v|version )?1 1
apache-2.0; apache; apache (?:software )?licen[cs]e (?:v ?|version )?2(?: 0)?
apache-2.0; apache; apache (?:v2|v 2|2 0|2)(?: 0)? (?:licen[cs]ed?)
gpl-1.0; general public; (?:gnu )?general public licen[cs]e (?:gpl )?(?:v ?|version )1(?: 0)?
gpl-2.0; general public; (?:gnu )?general public licen[cs]e (?:gpl )?(?:v ?|version )?2(?: 0)?
gpl-2.0; gplv2; (?:gnu )?gplv2
gpl-2.0; gpl 2; (?:gnu )?gpl (?:v |version )?2(?: 0)?
gpl-2.0-or-later; general public later; (?:gnu )?general public licen[cs]e (?:gpl )?(?:v ?|version )?2(?: 0)? or (?:any )?later
gpl-3.0; general public; (?:gnu )?general public licen[cs]e (?:gpl )?(?:v ?|version )?3(?: 0)?
gpl-3.0; gplv3; (?:gnu )?gplv3
gpl-3.0; gpl 3; (?:gnu )?gpl (?:v |version )?3(?: 0)?
gpl-3.0-or-later; general public later; (?:gnu )?general public licen[cs]e (?:gpl )?(?:v ?|version )?3(?: 0)? or (?:any )?later
lgpl-2.0; library public; (?:gnu )?library general public licen[cs]e (?:lgpl )?(?:v ?|version )?2(?: 0)?
lgpl-2.1; lesser public; (?:gnu )?lesser general public licen[cs]e (?:lgpl )?(?:v ?|version )?2 1
lgpl-2.1; lgplv2 1; (?:gnu )?lgplv2 1
lgpl-2.1; lgpl 2; (?:gnu )?lgpl (?:v |version )?2 1
lgpl-3.0; lesser public; (?:gnu )?lesser general public licen[cs]e (?:lgpl )?(?:v ?|version )?3(?: 0)?
lgpl-3.0; lgplv3; (?:gnu )?lgplv3
lgpl-3.0; lgpl 3; (?:gnu )?lgpl (?:v |version )?3(?: 0)?
agpl-3.0; affero public; (?:gnu )?affero general public licen[cs]e (?:agpl )?(?:v ?|version )?3(?: 0)?
agpl-3.0; agplv3; (?:gnu )?agplv3
agpl-3.0; agpl 3; (?:gnu )?agpl (?:v |version )?3(?: 0)?
gfdl-1.2; documentation 2; (?:gnu )?free documentation licen[cs]e (?:v ?|version )?1 2
gfdl-1.3; documentation 3; (?:gnu )?free documentation licen[cs]e (?:v ?|version )?1 3
bsd-2-clause; bsd; (?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd)(?: licen[cs]e)
bsd-3-clause; bsd; (?:bsd (?:3|three) clause|(?:3|three) clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)
bsd-4-clause; bsd; (?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd)(?: licen[cs]e)
mpl-1.0; mozilla public; mozilla public licen[cs]e (?:v ?|version )?1 0
mpl-1.1; mozilla public; mozilla public licen[cs]e (?:v ?|version )?1 1
mpl-2.0; mozilla public; mozilla public licen[cs]e (?:v ?|version )?2(?: 0)?
epl-1.0; eclipse public; eclipse public licen[cs]e (?:v ?|version )?1(?: 0)?
epl-2.0; eclipse public; eclipse public licen[cs]e (?:v ?|version )?2(?: 0)?
cddl-1.0; common distribution; common development and distribution licen[cs]e (?:cddl )?(?:v ?|version )?1 0
cpl-1.0; common public; common public licen[cs]e (?:v ?|version )?1 0
bsl-1.0; boost; boost software licen[cs]e (?:v ?|version )?1 0
artistic-1.0; artistic; artistic licen[cs]e (?:v ?|version )?1 0
artistic-2.0; artistic; artistic licen[cs]e (?:v ?|version )?2(?: 0)?
afl-3.0; academic free; academic free licen[cs]e (?:v ?|version )?3 0
osl-3.0; open; open software licen[cs]e (?:v ?|version )?3 0
eupl-1.1; european public; european union public licen[cs]e (?:eupl )?(?:v ?|version )?1 1
eupl-1.2; european public; european union public licen[cs]e (?:eupl )?(?:v ?|version )?1 2
ofl-1.1; sil font; sil open font licen[cs]e (?:v ?|version )?1 1
php-3.01; php; php licen[cs]e (?:v ?|version )?3 01
busl-1.1; business source; business source licen[cs]e (?:v ?|version )?1 1
sspl-1.0; server side; server side public licen[cs]e(?: (?:v ?|version )?1(?: 0)?)?
elastic-2.0; elastic; elastic licen[cs]e (?:v ?|version )?2(?: 0)?
ecl-2.0; educational community; educational community licen[cs]e (?:v ?|version )?2 0
cecill-2.1; cecill; cecill (?:free software )?(?:licen[cs]e )?(?:agreement )?(?:v ?|version )?2 1
mulan-psl-2.0; mulan; mulan permissive software licen[cs]e (?:v ?|version )?2
vim; vim; vim licen[cs]e
upl-1.0; universal permissive; universal permissive licen[cs]e (?:v ?|version )?1 0
"""

NAMES = r"""
mit; mit; (?:the )?mit (?:expat )?licen[cs]ed?
mit; expat; expat licen[cs]e
mit-0; mit; mit no attribution(?: licen[cs]e)?
apache; apache; apache (?:software )?licen[cs]ed?
gpl; gpl; (?:gnu )?gpl(?: licen[cs]ed?)?
gpl; general public; gnu general public licen[cs]e
lgpl; lgpl; (?:gnu )?lgpl(?: licen[cs]ed?)?
lgpl; lesser public; (?:gnu )?lesser general public licen[cs]e
lgpl; library public; (?:gnu )?library general public licen[cs]e
agpl; agpl; (?:gnu )?agpl(?: licen[cs]ed?)?
agpl; affero public; (?:gnu )?affero general public licen[cs]e
gfdl; gfdl; (?:gnu )?gfdl
gfdl; documentation; (?:gnu )?free documentation licen[cs]e
bsd; bsd; bsd (?:style )?licen[cs]ed?
isc; isc; isc licen[cs]ed?
zlib; zlib; zlib (?:libpng )?licen[cs]ed?
mpl; mozilla public; mozilla public licen[cs]e
epl; eclipse public; eclipse public licen[cs]e
cddl; cddl; cddl(?: licen[cs]e)?
bsl-1.0; boost; boost (?:software )?licen[cs]ed?
unlicense; unlicense; (?:the )?unlicense
wtfpl; wtfpl; wtfpl
wtfpl; want public; do what the fuck you want to public licen[cs]e
artistic; artistic; artistic licen[cs]e
cc; creative commons; creative commons(?: licen[cs]ed?)?
cc0-1.0; cc0; cc0(?: 1 0)?(?: universal)?
cc0-1.0; creative zero; creative commons zero
ofl-1.1; sil font; sil open font licen[cs]e
ofl-1.1; ofl; ofl licen[cs]ed
beerware; beerware; beerware(?: licen[cs]e)?
psf-2.0; python foundation; python software foundation licen[cs]e
ms-pl; microsoft public; microsoft public licen[cs]e
ms-rl; microsoft reciprocal; microsoft reciprocal licen[cs]e
eupl; eupl; eupl(?: licen[cs]e)?
odbl-1.0; open database; open (?:data commons )?database licen[cs]e
proprietary; proprietary; proprietary licen[cs]e
proprietary; commercial; commercial licen[cs]e
proprietary; end user; end user licen[cs]e agreement
public-domain; public domain; (?:in|into|to) the public domain
"""

# the phrases of the base count
BASE = r"""
mit; mit license; mit license
apache; apache license; apache license
gpl; general public license; general public license
"""

# short identifiers; tags and manifest fields are built from them
IDENTIFIERS = """
0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-2-Clause
BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0
EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only
GPL-3.0-or-later ISC LGPL-2.0 LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0
MPL-1.1 MPL-2.0 MS-PL MS-RL NCSA ODbL-1.0 OFL-1.1 OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 SSPL-1.0
Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1
""".split()

CC_PARTS = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative|atives|s)(?: works)?", "sa": "share ?alike"}
CC_KINDS = ["by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
