"""Hand-written signatures: sentences of license bodies, notices, tags and exceptions.

Texts are words in lower case with single spaces.  ``..N`` allows up to N words in
between, ``(a|b)`` is a choice, ``a?`` in brackets may be missing.  A line is
``label | priority | confidence | signature``; of detections with equal spans the
higher priority stays, so tags (6) go before bodies (5), bodies before notices (4),
notices before mentions (3 and less).
"""

from __future__ import annotations

#: The public short identifiers of licenses, as their words follow an identifier tag.
TAGGED = """
0BSD AAL AFL-1.1 AFL-1.2 AFL-2.0 AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-3.0 Apache-1.0 Apache-1.1 Apache-2.0 APSL-1.0 APSL-2.0
Artistic-1.0 Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause BSD-2-Clause-Patent BSL-1.0 BUSL-1.1 bzip2-1.0.6
CAL-1.0 CC0-1.0 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-1.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0
CC-BY-NC-2.0 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0
CDDL-1.0 CDDL-1.1 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C CPAL-1.0 CPL-1.0 curl ECL-2.0 EFL-2.0 EPL-1.0 EPL-2.0 EUDatagrid EUPL-1.1 EUPL-1.2
FSFAP FTL GFDL-1.1 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 HPND ICU IJG Info-ZIP IPL-1.0 ISC JSON
LGPL-2.0 LGPL-2.1 LGPL-3.0 Libpng LPL-1.02 LPPL-1.3c MirOS MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0
NASA-1.3 NCSA NPL-1.1 NTP ODbL-1.0 ODC-By-1.0 OFL-1.0 OFL-1.1 OpenSSL OSL-1.0 OSL-2.0 OSL-2.1 OSL-3.0 PDDL-1.0 PHP-3.0 PHP-3.01 PostgreSQL
PSF-2.0 Python-2.0 QPL-1.0 RPL-1.5 Ruby SGI-B-2.0 Sleepycat SPL-1.0 SSPL-1.0 TCL Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Xnet
XFree86-1.1 Zlib ZPL-2.0 ZPL-2.1
"""

#: Signatures.
SIGNATURES = """
mit | 5 | 1.0 | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 5 | 1.0 | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
mit | 5 | 0.9 | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | 4 | 0.7 | the software is provided as is without warranty of any kind express or implied
mit-0 | 5 | 0.9 | permission is hereby granted free of charge ..30 without restriction ..40 and to permit persons to whom the software is furnished to do so the software is provided
x11 | 5 | 0.9 | the name of the x consortium shall not be used in advertising
x11 | 5 | 0.9 | except as contained in this notice the names? of ..8 shall not be used in advertising or otherwise to promote
isc | 5 | 1.0 | permission to use copy modify and (or )?distribute this software for any purpose with or without fee is hereby granted
isc | 5 | 0.8 | provided that the above copyright notice and this permission notice appear in all copies
0bsd | 5 | 0.9 | distribute this software for any purpose with or without fee is hereby granted the software is provided
hpnd | 5 | 0.9 | permission to use copy modify and distribute this software and its documentation for any purpose ..6 hereby granted
ntp | 5 | 0.9 | permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted
bsd | 5 | 0.9 | redistribution and use in source and binary forms with or without modification are permitted
bsd | 5 | 0.8 | redistributions of source code must retain the ..3 copyright notice this list of conditions and the following disclaimer
bsd | 5 | 0.8 | redistributions in binary form must reproduce the above copyright notice this list of conditions
bsd | 4 | 0.7 | this software is provided by the ..6 as is and any express or implied warranties
bsd | 4 | 0.6 | in no event shall the ..8 be liable for any direct indirect incidental special exemplary or consequential damages
bsd-3-clause | 5 | 1.0 | neither the names? of ..12 nor the names of (its|their|any) ..3 may be used to endorse or promote products derived
bsd-4-clause | 5 | 1.0 | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-2-clause-patent | 5 | 0.9 | a perpetual worldwide non exclusive no charge royalty free irrevocable ..6 patent license ..12 contributions?
bsd | 3 | 0.8 | use of this source code is governed by a bsd (style )?license
mit | 3 | 0.8 | use of this source code is governed by an mit (style )?license
apache-2.0 | 3 | 0.8 | use of this source code is governed by the apache 2 0 license
gpl | 5 | 0.9 | this program is free software you can redistribute it and or modify it under the terms of
gpl | 5 | 0.8 | this program is free software you can redistribute it
gpl | 5 | 0.9 | this program is distributed in the hope that it will be useful but without any warranty
gpl | 5 | 0.8 | you should have received a copy of the gnu general public licen[sc]e
gpl | 5 | 0.9 | the licenses for most software are designed to take away your freedom to share and change it
gpl | 5 | 0.9 | when we speak of free software we are referring to freedom not price
gpl-2.0 | 5 | 0.9 | gnu general public license ..6 version 2 (of the license )?as published by the free software foundation
gpl-2.0 | 5 | 1.0 | gnu general public license as published by the free software foundation (either )?version 2
gpl-3.0 | 5 | 1.0 | gnu general public license as published by the free software foundation (either )?version 3
gpl-2.0-or-later | 5 | 1.0 | gnu general public license as published by the free software foundation either version 2 of the license or (at your option )?any later version
gpl-3.0-or-later | 5 | 1.0 | gnu general public license as published by the free software foundation either version 3 of the license or (at your option )?any later version
gpl-2.0-or-later | 4 | 0.9 | gpl ?v?2 or (later|newer|above)
gpl-3.0-or-later | 4 | 0.9 | gpl ?v?3 or (later|newer|above)
gpl-2.0-only | 4 | 0.9 | gpl ?v?2 only
gpl-3.0-only | 4 | 0.9 | gpl ?v?3 only
gpl-1.0-or-later | 4 | 0.7 | under the same terms as perl itself
gpl-2.0 | 3 | 0.8 | gplv2
gpl-3.0 | 3 | 0.8 | gplv3
lgpl-2.1 | 3 | 0.8 | lgplv2 1
lgpl-3.0 | 3 | 0.8 | lgplv3
agpl-3.0 | 3 | 0.8 | agplv3
lgpl | 5 | 0.9 | this library is free software you can redistribute it and or modify it
lgpl | 5 | 0.9 | you should have received a copy of the gnu (lesser|library) general public license
lgpl-2.0 | 5 | 1.0 | gnu library general public license as published by the free software foundation (either )?version 2
lgpl-2.1 | 5 | 1.0 | gnu lesser general public license as published by the free software foundation (either )?version 2 1
lgpl-3.0 | 5 | 1.0 | gnu lesser general public license as published by the free software foundation (either )?version 3
lgpl | 5 | 0.8 | a program that contains no derivative of any portion of the library but is designed to work with the library
agpl-3.0 | 5 | 1.0 | gnu affero general public license as published by the free software foundation (either )?version 3
agpl-3.0 | 5 | 0.9 | users interacting with it remotely through a computer network ..20 opportunity to receive the corresponding source
agpl | 5 | 0.9 | you should have received a copy of the gnu affero general public license
gfdl | 5 | 1.0 | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | 4 | 0.8 | with no invariant sections no front cover texts and no back cover texts
classpath-exception-2.0 | 5 | 1.0 | linking this library statically or dynamically with other modules is making a combined work based on this library
classpath-exception-2.0 | 4 | 0.9 | with (the )?(gnu )?classpath exception
gcc-exception-3.1 | 4 | 0.9 | gcc runtime library exception
autoconf-exception | 4 | 0.9 | as a special exception to the gnu general public license if you distribute this file as part of a program that contains a configuration script generated by autoconf
bison-exception | 4 | 0.9 | as a special exception you may create a larger work that contains part or all of the bison parser skeleton
font-exception-2.0 | 4 | 0.9 | as a special exception if you create a document which uses this font
openssl-exception | 4 | 0.9 | permission to link the code of ..8 with the openssl library
linking-exception | 4 | 0.8 | with (a |the )?(static )?linking exception
llvm-exception | 4 | 0.9 | with (the )?llvm exceptions?
linux-syscall-note | 4 | 0.9 | with linux syscall note
apache-2.0 | 5 | 1.0 | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | 5 | 1.0 | you may obtain a copy of the license at http www apache org licenses license 2 0
apache-2.0 | 4 | 0.8 | apache org licenses license 2 0
apache-2.0 | 4 | 0.9 | (licensed|released|available|distributed) under (the )?apache (license )?v?2
apache | 5 | 0.8 | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 | 5 | 0.9 | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache-1.1 | 5 | 0.9 | this product includes software developed by the apache software foundation http www apache org
apache | 3 | 0.7 | licensed to the apache software foundation asf under one or more contributor license agreements
mpl-2.0 | 5 | 1.0 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 5 | 0.9 | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1 | 5 | 1.0 | the contents of this file are subject to the mozilla public license version 1 1
mpl-1.1 | 4 | 0.8 | software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license for the specific language
npl-1.1 | 5 | 0.9 | the contents of this file are subject to the netscape public license
cddl | 5 | 0.9 | the contents of this file are subject to the terms of the common development and distribution license
epl-1.0 | 5 | 1.0 | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
epl-2.0 | 5 | 1.0 | this program and the accompanying materials are made available under the terms of the eclipse public license (v 2 0|v2 0|2 0)
epl | 4 | 0.8 | the accompanying program is provided under the terms of this eclipse public license
cpl-1.0 | 4 | 0.9 | the accompanying program is provided under the terms of this common public license
eupl | 5 | 0.9 | licensed under the eupl
cecill | 5 | 0.9 | this software is governed by the cecill ..4 license under french law
artistic | 5 | 0.9 | the intent of this document is to state the conditions under which a package may be copied
artistic-2.0 | 5 | 0.9 | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed ..20 artistic
artistic | 4 | 0.8 | under the terms of the artistic license
perl | 4 | 0.8 | same terms as (the )?perl ..6 (itself|language)
zlib | 5 | 1.0 | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | 5 | 1.0 | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib | 5 | 0.9 | the origin of this software must not be misrepresented
bsl-1.0 | 5 | 1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
bsl-1.0 | 5 | 0.9 | distributed under the boost software license version 1 0
busl-1.1 | 5 | 0.9 | use of the licensed work ..10 change date ..20 change license
unlicense | 5 | 1.0 | this is free and unencumbered software released into the public domain
unlicense | 5 | 0.9 | anyone is free to copy modify publish use compile sell or distribute this software
wtfpl | 5 | 1.0 | do what the fuck you want to public license
wtfpl | 5 | 0.9 | you just do what the fuck you want to
beerware | 5 | 0.9 | the beer ware license
beerware | 5 | 0.9 | if we meet some day and you think this stuff is worth it you can buy me a beer
cc0-1.0 | 5 | 1.0 | the person who associated a work with this deed has dedicated the work to the public domain
cc0-1.0 | 5 | 0.9 | to the extent possible under law ..20 waived all copyright and related or neighboring rights
cc0-1.0 | 4 | 0.9 | creativecommons org publicdomain zero 1 0
public-domain | 4 | 0.8 | (released|placed|dedicated|put) (in|into|to) the public domain
public-domain | 4 | 0.7 | (this|the) (file|code|software|work|text) is in the public domain
public-domain | 4 | 0.7 | the author disclaims copyright to this source code
public-domain | 3 | 0.6 | no rights reserved
pddl-1.0 | 4 | 0.9 | opendatacommons org licenses pddl
odbl-1.0 | 4 | 0.9 | opendatacommons org licenses odbl
odc-by-1.0 | 4 | 0.9 | opendatacommons org licenses by
cc-by | 4 | 0.9 | creativecommons org licenses by
cc-by-1.0 | 4 | 1.0 | creativecommons org licenses by 1 0
cc-by-2.0 | 4 | 1.0 | creativecommons org licenses by 2 0
cc-by-2.5 | 4 | 1.0 | creativecommons org licenses by 2 5
cc-by-3.0 | 4 | 1.0 | creativecommons org licenses by 3 0
cc-by-4.0 | 4 | 1.0 | creativecommons org licenses by 4 0
cc-by-sa-2.0 | 4 | 1.0 | creativecommons org licenses by sa 2 0
cc-by-sa-3.0 | 4 | 1.0 | creativecommons org licenses by sa 3 0
cc-by-sa-4.0 | 4 | 1.0 | creativecommons org licenses by sa 4 0
cc-by-nc-3.0 | 4 | 1.0 | creativecommons org licenses by nc 3 0
cc-by-nc-4.0 | 4 | 1.0 | creativecommons org licenses by nc 4 0
cc-by-nd-4.0 | 4 | 1.0 | creativecommons org licenses by nd 4 0
cc-by-nc-sa-3.0 | 4 | 1.0 | creativecommons org licenses by nc sa 3 0
cc-by-nc-sa-4.0 | 4 | 1.0 | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-3.0 | 4 | 1.0 | creativecommons org licenses by nc nd 3 0
cc-by-nc-nd-4.0 | 4 | 1.0 | creativecommons org licenses by nc nd 4 0
cc-by | 4 | 0.8 | creative commons attribution (international |unported |generic )?licen[sc]e
cc-by-sa | 4 | 0.8 | you are free to share ..12 under the following terms attribution ..20 sharealike
cc-by-nc | 4 | 0.8 | you may not use the material for commercial purposes
cc-by-nd | 4 | 0.8 | if you remix transform or build upon the material you may not distribute the modified material
ofl-1.1 | 5 | 1.0 | this font software is licensed under the sil open font license version 1 1
ofl | 5 | 0.9 | the font software may be sold as part of a larger software package
ofl | 4 | 0.8 | with reserved font names?
ftl | 5 | 0.9 | portions of this software are copyright ..8 the freetype project
ijg | 5 | 0.9 | this software is based in part on the work of the independent jpeg group
libpng | 5 | 0.9 | the png reference library is supplied as is
openssl | 5 | 1.0 | this product includes software developed by the openssl project for use in the openssl toolkit
ssleay | 5 | 0.9 | this product includes cryptographic software written by eric young
curl | 5 | 0.8 | except as contained in this notice the name of a copyright holder shall not be used in advertising ..12 in this software
json | 5 | 1.0 | the software shall be used for good not evil
php | 5 | 0.9 | this product includes php software freely available from
python-2.0 | 5 | 0.9 | this license agreement is between the python software foundation psf and the individual or organization licensee
postgresql | 5 | 0.9 | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
tcl | 5 | 0.9 | the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose
unicode | 5 | 0.9 | permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
icu | 5 | 0.9 | provided that the above copyright notice s and this permission notice appear in all copies of the software
ncsa | 5 | 1.0 | permission is hereby granted ..40 to deal with the software without restriction
w3c | 5 | 0.9 | this work is being provided by the copyright holders under the following license
w3c | 4 | 0.8 | w3c software (notice and )?license
w3c | 4 | 0.8 | w3c document license
ms-pl | 5 | 0.9 | this license governs use of the accompanying software if you use the software you accept this license
ms-rl | 5 | 0.8 | reciprocal grants for any file you distribute that contains code from the software
sspl-1.0 | 5 | 0.9 | if you make the functionality of the program ..12 available to third parties as a service
elastic-2.0 | 5 | 0.9 | you may not provide the software to third parties as a hosted or managed service
commons-clause | 5 | 1.0 | commons clause license condition
commons-clause | 5 | 0.9 | the license does not grant to you the right to sell the software
polyform | 5 | 0.9 | polyform (noncommercial|strict|shield|perimeter|small business|internal use) license
osl-3.0 | 5 | 0.9 | licensed under the open software license version 3 0
afl-3.0 | 5 | 0.9 | licensed under the academic free license version 3 0
lppl | 5 | 0.9 | this work may be distributed and or modified under the conditions of the latex project public license
qpl-1.0 | 5 | 0.9 | this file may be distributed under the terms of the q public license
sleepycat | 5 | 0.9 | redistributions in any form must be accompanied by information on how to obtain complete source code
vim | 5 | 0.9 | there are no restrictions on distributing unmodified copies of vim
upl-1.0 | 5 | 0.9 | subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software ..20 larger works
mulan-psl-2.0 | 5 | 0.9 | licensed under mulan psl v2
blueoak-1.0.0 | 5 | 0.9 | blue oak model license
fair | 5 | 0.8 | usage of the works is permitted provided that this instrument is retained with the works
fsfap | 5 | 0.9 | copying and distribution of this file with or without modification are permitted in any medium without royalty
fsful | 5 | 0.8 | this configure script is free software the free software foundation gives unlimited permission to copy distribute and modify it
info-zip | 5 | 0.8 | redistributions of source code must retain the above copyright notice definition disclaimer and this list of conditions
dual | 4 | 0.8 | (dual|multi|triple) licensed under
dual | 4 | 0.8 | under either of ..8 at your option
dual | 4 | 0.8 | may be used under the terms of either
dual | 4 | 0.8 | alternatively this (software|file|code) may be distributed under the terms of
mit | 4 | 0.9 | licensed under ..2 mit
apache-2.0 | 4 | 0.9 | licensed under ..4 apache ..2 2 0
apache-2.0 | 4 | 0.9 | apache 2 0 or mit
mit | 4 | 0.9 | mit or apache 2 0
mit | 4 | 0.9 | mit and gpl licenses
proprietary | 4 | 0.8 | unauthorized copying of this (file|software|material) ..6 is strictly prohibited
proprietary | 4 | 0.8 | this (software|document|file) (is|contains) (the )?confidential and proprietary
proprietary | 4 | 0.8 | this (software|document|file) (is|contains) (the )?proprietary and confidential
proprietary | 4 | 0.7 | no part of this (publication|work|book|document) may be reproduced
proprietary | 4 | 0.7 | may not be reproduced (or )?..6 without (the )?(prior |express )?written (permission|consent)
proprietary | 4 | 0.7 | you may not (copy|rent|lease|sell|modify) ..8 reverse engineer
proprietary | 4 | 0.6 | for internal use only
evaluation | 4 | 0.7 | for (evaluation|trial) purposes only
non-commercial | 4 | 0.7 | for non commercial (use|purposes) only
non-commercial | 4 | 0.7 | for noncommercial (use|purposes) only
non-commercial | 4 | 0.7 | for academic (use|purposes) only
non-commercial | 4 | 0.7 | for educational (use|purposes) only
non-commercial | 4 | 0.7 | not (be )?(used|for use) for commercial purposes
mit | 3 | 0.7 | license mit
isc | 3 | 0.7 | license isc
bsd | 3 | 0.7 | license bsd
apache | 3 | 0.7 | license apache
gpl | 3 | 0.7 | license gpl
lgpl | 3 | 0.7 | license lgpl
mpl | 3 | 0.7 | license mpl
unlicense | 3 | 0.7 | license unlicense
copyright | 1 | 0.5 | copyright c (19|20)[0-9][0-9]
copyright | 1 | 0.5 | copyright (19|20)[0-9][0-9]
license-file | 2 | 0.5 | see (the )?license (file )?for (details|more information)
license-file | 2 | 0.5 | see (the )?copying (file )?for (details|more information)
license-file | 2 | 0.5 | license file (that was|which was|which is)? ?distributed with this (source code|file|software)
"""
