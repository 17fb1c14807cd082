"""The signature rules of the license scan, in order.

A line is ``label | priority | keyword | pattern``.  Patterns are Java regular
expressions over a text's words in lower case, joined by single spaces; a match begins
and ends at words.  A rule is tried only on texts that hold its keyword as a word.
Priority 1 is a license's grant or identifier, 2 its full name, 3 a short name, 4 a
statement that names no license.  ``<2.1>`` stands for that version in any usual
notation, ``<+>`` for "or any later version" and ``<the>`` for an optional article.
"""

from __future__ import annotations

import re
from typing import NamedTuple

TABLE = r"""
# GNU General Public License
gpl-3.0+      | 1 | gnu      | gnu general public license(?: as published by the free software foundation)?(?: either)?<3><+>
gpl-2.0+      | 1 | gnu      | gnu general public license(?: as published by the free software foundation)?(?: either)?<2><+>
gpl-1.0+      | 1 | gnu      | gnu general public license(?: as published by the free software foundation)?(?: either)?<1><+>
gpl-3.0       | 1 | gnu      | gnu general public license<3>(?: only)?
gpl-2.0       | 1 | gnu      | gnu general public license<2>(?: only)?
gpl-1.0       | 1 | gnu      | gnu general public license<1>(?: only)?
gpl-3.0       | 1 | gnu      | version 3 of <the>gnu general public license
gpl-2.0       | 1 | gnu      | version 2 of <the>gnu general public license
gpl           | 2 | gnu      | (?:gnu )?general public licen[cs]e
gpl           | 2 | gnu      | gnu public licen[cs]e
gpl           | 2 | gnu      | gnu gpl
gpl-3.0+      | 1 | gplv3    | (?:gnu )?gplv3<+>
gpl-3.0       | 1 | gplv3    | (?:gnu )?gplv3(?: only)?
gpl-2.0+      | 1 | gplv2    | (?:gnu )?gplv2<+>
gpl-2.0       | 1 | gplv2    | (?:gnu )?gplv2(?: only)?
gpl-3.0+      | 1 | gpl      | (?:gnu )?gpl<3><+>
gpl-2.0+      | 1 | gpl      | (?:gnu )?gpl<2><+>
gpl-1.0+      | 1 | gpl      | (?:gnu )?gpl<1><+>
gpl-3.0       | 1 | gpl      | (?:gnu )?gpl<3>(?: only)?
gpl-2.0       | 1 | gpl      | (?:gnu )?gpl<2>(?: only)?
gpl-1.0       | 1 | gpl      | (?:gnu )?gpl<1>(?: only)?
gpl           | 3 | gpl      | (?:licen[cs]ed|released|distributed|available|published) under <the>gpl
gpl           | 3 | gpl      | gpl licen[cs]ed?
gpl           | 3 | gpl      | <the>gpl licen[cs]e
gpl-classpath | 1 | classpath | gpl<2> (?:with|w) (?:the )?classpath exception
gpl-classpath | 1 | classpath | gnu general public license<2> with (?:the )?classpath exception
gpl-linking   | 1 | linking  | (?:gpl|gnu general public license)(?: [0-9v]+){0,3} with (?:a )?(?:special )?linking exception
gpl-gcc       | 1 | gcc      | (?:gpl|gnu general public license)(?: [0-9v]+){0,3} with (?:the )?gcc (?:runtime library )?exception
gpl           | 1 | redistribute | you can redistribute it and or modify it under the terms of the gnu general public license
gpl           | 1 | warranty | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
# GNU Lesser and Library
lgpl-3.0+     | 1 | lesser   | gnu lesser general public license(?: as published by the free software foundation)?(?: either)?<3><+>
lgpl-2.1+     | 1 | lesser   | gnu lesser general public license(?: as published by the free software foundation)?(?: either)?<2.1><+>
lgpl-3.0      | 1 | lesser   | gnu lesser general public license<3>(?: only)?
lgpl-2.1      | 1 | lesser   | gnu lesser general public license<2.1>(?: only)?
lgpl-2.0+     | 1 | library  | gnu library general public license<2><+>
lgpl-2.0      | 1 | library  | gnu library general public license<2>
lgpl          | 2 | lesser   | (?:gnu )?lesser general public licen[cs]e
lgpl          | 2 | library  | (?:gnu )?library general public licen[cs]e
lgpl-3.0+     | 1 | lgpl     | (?:gnu )?lgpl<3><+>
lgpl-2.1+     | 1 | lgpl     | (?:gnu )?lgpl<2.1><+>
lgpl-2.0+     | 1 | lgpl     | (?:gnu )?lgpl<2><+>
lgpl-3.0      | 1 | lgpl     | (?:gnu )?lgpl<3>(?: only)?
lgpl-2.1      | 1 | lgpl     | (?:gnu )?lgpl<2.1>(?: only)?
lgpl-2.0      | 1 | lgpl     | (?:gnu )?lgpl<2>(?: only)?
lgpl-3.0      | 1 | lgplv3   | (?:gnu )?lgplv3
lgpl-2.1      | 1 | lgplv2   | (?:gnu )?lgplv2 1
lgpl          | 3 | lgpl     | (?:licen[cs]ed|released|distributed|available|published) under <the>lgpl
lgpl          | 3 | lgpl     | lgpl licen[cs]ed?
# GNU Affero, Free Documentation
agpl-3.0+     | 1 | affero   | (?:gnu )?affero general public license(?: as published by the free software foundation)?(?: either)?<3><+>
agpl-3.0      | 1 | affero   | (?:gnu )?affero general public license<3>(?: only)?
agpl-1.0      | 1 | affero   | affero general public license<1>(?: only)?
agpl          | 2 | affero   | (?:gnu )?affero general public licen[cs]e
agpl-3.0+     | 1 | agpl     | (?:gnu )?agpl<3><+>
agpl-3.0      | 1 | agpl     | (?:gnu )?agpl<3>(?: only)?
agpl-3.0      | 1 | agplv3   | (?:gnu )?agplv3
agpl          | 3 | agpl     | (?:licen[cs]ed|released|distributed|available|published) under <the>agpl
gfdl-1.3      | 1 | documentation | gnu free documentation license<1.3>
gfdl-1.2      | 1 | documentation | gnu free documentation license<1.2>
gfdl-1.1      | 1 | documentation | gnu free documentation license<1.1>
gfdl          | 2 | documentation | (?:gnu )?free documentation licen[cs]e
gfdl          | 3 | gfdl     | (?:gnu )?gfdl(?: 1 [123])?(?: or later| only)?
# Apache
apache-2.0    | 1 | apache   | (?:the )?apache licen[cs]e<2>
apache-2.0    | 1 | apache   | apache software licen[cs]e<2>
apache-1.1    | 1 | apache   | apache (?:software )?licen[cs]e<1.1>
apache-1.0    | 1 | apache   | apache (?:software )?licen[cs]e<1>
apache-2.0    | 1 | apache   | licen[cs]ed under <the>apache licen[cs]e<2>
apache-2.0    | 1 | apache   | www apache org licenses license 2 0
apache-2.0    | 1 | apache   | apache 2(?: 0)?(?: licen[cs]ed?)?
apache        | 2 | apache   | apache (?:software )?licen[cs]e
apache        | 2 | apache   | apache public licen[cs]e
apache-2.0    | 1 | asl      | (?:apache )?asl<2>
apache        | 3 | apache   | (?:licen[cs]ed|released|distributed|available) under <the>apache
# MIT and X11
mit           | 1 | mit      | spdx license identifier mit
mit           | 1 | mit      | (?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?mit(?: licen[cs]e)?
mit           | 2 | mit      | (?:the )?mit licen[cs]ed?
mit           | 2 | mit      | mit x11 licen[cs]e
mit           | 2 | expat    | expat licen[cs]e
mit           | 3 | mit      | mit style licen[cs]e
mit           | 1 | hereby   | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit           | 1 | noninfringement | the warranties of merchantability fitness for a particular purpose and noninfringement
mit-0         | 1 | mit      | mit (?:licen[cs]e )?no attribution
mit-0         | 1 | mit      | spdx license identifier mit 0
mit-0         | 1 | mit      | mit 0(?: licen[cs]e)?
mit-modern    | 1 | modern   | mit licen[cs]e modern variant
x11           | 2 | x11      | x11 licen[cs]e
x11           | 1 | consortium | except as contained in this notice the name of the x consortium shall not be used in advertising
# BSD
bsd-3-clause  | 1 | bsd      | bsd 3 clause(?: (?:new|revised|simplified))?(?: licen[cs]e)?
bsd-3-clause  | 1 | bsd      | (?:3|three) clause bsd(?: licen[cs]e)?
bsd-3-clause  | 1 | bsd      | (?:new|revised|modified) bsd licen[cs]e
bsd-2-clause  | 1 | bsd      | bsd 2 clause(?: simplified)?(?: licen[cs]e)?
bsd-2-clause  | 1 | bsd      | (?:2|two) clause bsd(?: licen[cs]e)?
bsd-2-clause  | 1 | bsd      | (?:simplified|freebsd) bsd licen[cs]e
bsd-2-clause  | 1 | freebsd  | freebsd licen[cs]e
bsd-4-clause  | 1 | bsd      | bsd 4 clause(?: (?:original|old))?(?: licen[cs]e)?
bsd-4-clause  | 1 | bsd      | (?:4|four) clause bsd(?: licen[cs]e)?
bsd-4-clause  | 1 | bsd      | (?:original|old) bsd licen[cs]e
bsd-1-clause  | 1 | bsd      | bsd 1 clause(?: licen[cs]e)?
bsd-0-clause  | 1 | bsd      | (?:bsd (?:0|zero) clause|(?:0|zero) clause bsd)(?: licen[cs]e)?
bsd-0-clause  | 1 | 0bsd     | 0bsd
bsd-patent    | 1 | bsd      | bsd 2 clause plus patent(?: licen[cs]e)?
bsd-protection | 1 | bsd     | bsd protection licen[cs]e
bsd           | 2 | bsd      | (?:the )?bsd licen[cs]ed?
bsd           | 3 | bsd      | bsd style licen[cs]e
bsd           | 3 | bsd      | (?:licen[cs]ed|released|distributed|available) under <the>bsd
bsd           | 1 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause  | 1 | endorse  | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause  | 1 | advertising | all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
bsd           | 1 | contributors | provided by the copyright holders and contributors as is and any express or implied warranties
# Creative Commons
cc-by-nc-nd-4.0 | 1 | cc     | cc by nc nd<4>
cc-by-nc-nd-3.0 | 1 | cc     | cc by nc nd<3>
cc-by-nc-nd-2.5 | 1 | cc     | cc by nc nd<2.5>
cc-by-nc-nd-2.0 | 1 | cc     | cc by nc nd<2>
cc-by-nc-nd     | 2 | cc     | cc by nc nd
cc-by-nc-sa-4.0 | 1 | cc     | cc by nc sa<4>
cc-by-nc-sa-3.0 | 1 | cc     | cc by nc sa<3>
cc-by-nc-sa-2.5 | 1 | cc     | cc by nc sa<2.5>
cc-by-nc-sa-2.0 | 1 | cc     | cc by nc sa<2>
cc-by-nc-sa     | 2 | cc     | cc by nc sa
cc-by-nc-4.0    | 1 | cc     | cc by nc<4>
cc-by-nc-3.0    | 1 | cc     | cc by nc<3>
cc-by-nc-2.5    | 1 | cc     | cc by nc<2.5>
cc-by-nc-2.0    | 1 | cc     | cc by nc<2>
cc-by-nc        | 2 | cc     | cc by nc
cc-by-nd-4.0    | 1 | cc     | cc by nd<4>
cc-by-nd-3.0    | 1 | cc     | cc by nd<3>
cc-by-nd-2.0    | 1 | cc     | cc by nd<2>
cc-by-nd        | 2 | cc     | cc by nd
cc-by-sa-4.0    | 1 | cc     | cc by sa<4>
cc-by-sa-3.0    | 1 | cc     | cc by sa<3>
cc-by-sa-2.5    | 1 | cc     | cc by sa<2.5>
cc-by-sa-2.0    | 1 | cc     | cc by sa<2>
cc-by-sa        | 2 | cc     | cc by sa
cc-by-4.0       | 1 | cc     | cc by<4>
cc-by-3.0       | 1 | cc     | cc by<3>
cc-by-2.5       | 1 | cc     | cc by<2.5>
cc-by-2.0       | 1 | cc     | cc by<2>
cc-by-1.0       | 1 | cc     | cc by<1>
cc0-1.0         | 1 | cc0    | cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?
cc0-1.0         | 1 | cc     | cc zero(?: 1 0)?
cc-by-nc-nd     | 1 | creative | creative commons attribution non ?commercial no ?deriv(?:s|ative|atives)(?: works)?(?: \d \d)?(?: (?:international|unported|generic))?(?: (?:public )?licen[cs]e)?
cc-by-nc-sa     | 1 | creative | creative commons attribution non ?commercial share ?alike(?: \d \d)?(?: (?:international|unported|generic))?(?: (?:public )?licen[cs]e)?
cc-by-nc        | 1 | creative | creative commons attribution non ?commercial(?: \d \d)?(?: (?:international|unported|generic))?(?: (?:public )?licen[cs]e)?
cc-by-nd        | 1 | creative | creative commons attribution no ?deriv(?:s|ative|atives)(?: works)?(?: \d \d)?(?: (?:international|unported|generic))?(?: (?:public )?licen[cs]e)?
cc-by-sa        | 1 | creative | creative commons attribution share ?alike(?: \d \d)?(?: (?:international|unported|generic))?(?: (?:public )?licen[cs]e)?
cc-by           | 1 | creative | creative commons attribution(?: \d \d)?(?: (?:international|unported|generic))?(?: (?:public )?licen[cs]e)?
cc0-1.0         | 1 | creative | creative commons (?:zero|cc0)(?: (?:v|version )?1 0)?(?: universal)?
cc-by-nc-nd     | 1 | creativecommons | creativecommons org licenses by nc nd(?: \d \d)?
cc-by-nc-sa     | 1 | creativecommons | creativecommons org licenses by nc sa(?: \d \d)?
cc-by-nc        | 1 | creativecommons | creativecommons org licenses by nc(?: \d \d)?
cc-by-nd        | 1 | creativecommons | creativecommons org licenses by nd(?: \d \d)?
cc-by-sa        | 1 | creativecommons | creativecommons org licenses by sa(?: \d \d)?
cc-by           | 1 | creativecommons | creativecommons org licenses by(?: \d \d)?
cc0-1.0         | 1 | creativecommons | creativecommons org publicdomain zero(?: \d \d)?
cc-pdm-1.0      | 1 | creativecommons | creativecommons org publicdomain mark(?: \d \d)?
cc              | 2 | creative | creative commons licen[cs]e
cc              | 3 | creative | (?:licen[cs]ed|released|distributed|available|published) under <the>creative commons
# Mozilla, Eclipse, CDDL, other copyleft
mpl-2.0       | 1 | mozilla  | mozilla public licen[cs]e<2>
mpl-1.1       | 1 | mozilla  | mozilla public licen[cs]e<1.1>
mpl-1.0       | 1 | mozilla  | mozilla public licen[cs]e<1>
mpl           | 2 | mozilla  | mozilla public licen[cs]e
mpl-2.0       | 1 | mpl      | mpl<2>
mpl-1.1       | 1 | mpl      | mpl<1.1>
mpl-2.0       | 1 | mplv2    | mplv2(?: 0)?
npl           | 2 | netscape | netscape public licen[cs]e(?: version)?(?: 1 [01])?
epl-2.0       | 1 | eclipse  | eclipse public licen[cs]e<2>
epl-1.0       | 1 | eclipse  | eclipse public licen[cs]e<1>
epl           | 2 | eclipse  | eclipse public licen[cs]e
edl-1.0       | 2 | eclipse  | eclipse distribution licen[cs]e(?: v| version)?(?: 1 0)?
epl-2.0       | 1 | epl      | epl<2>
epl-1.0       | 1 | epl      | epl<1>
cpl-1.0       | 2 | common   | common public licen[cs]e(?: version)?(?: 1 0)?
cpal-1.0      | 2 | common   | common public attribution licen[cs]e(?: version)?(?: 1 0)?
ipl-1.0       | 2 | ibm      | ibm public licen[cs]e(?: version)?(?: 1 0)?
cddl-1.1      | 1 | cddl     | cddl<1.1>
cddl-1.0      | 1 | cddl     | cddl<1>
cddl          | 2 | distribution | common development and distribution licen[cs]e
cddl          | 3 | cddl     | cddl licen[cs]ed?
eupl-1.2      | 1 | eupl     | eupl<1.2>
eupl-1.1      | 1 | eupl     | eupl<1.1>
eupl          | 2 | european | european union public licen[cs]e(?: v| version)?(?: 1 [0-2])?
osl-3.0       | 1 | open     | open software licen[cs]e<3>
osl           | 2 | open     | open software licen[cs]e
afl-3.0       | 1 | academic | academic free licen[cs]e<3>
afl           | 2 | academic | academic free licen[cs]e
rpl           | 2 | reciprocal | reciprocal public licen[cs]e(?: 1 [15])?
ms-rl         | 2 | reciprocal | microsoft reciprocal licen[cs]e
ms-pl         | 2 | microsoft | microsoft public licen[cs]e
apsl-2.0      | 1 | apple    | apple public source licen[cs]e<2>
apsl          | 2 | apple    | apple public source licen[cs]e
cecill-2.1    | 1 | cecill   | cecill(?: (?:v|version))? ?2 1
cecill-b      | 1 | cecill   | cecill b(?: licen[cs]e)?
cecill-c      | 1 | cecill   | cecill c(?: licen[cs]e)?
cecill        | 2 | cecill   | cecill licen[cs]e
sleepycat     | 2 | sleepycat | sleepycat licen[cs]e
qpl-1.0       | 2 | q        | q public licen[cs]e(?: version)?(?: 1 0)?
lppl-1.3      | 1 | latex    | latex project public licen[cs]e<1.3c?>
lppl          | 2 | latex    | latex project public licen[cs]e
artistic-2.0  | 1 | artistic | artistic licen[cs]e<2>
artistic-1.0  | 1 | artistic | artistic licen[cs]e<1>
artistic      | 2 | artistic | (?:the )?artistic licen[cs]e
# Other permissive
isc           | 2 | isc      | isc licen[cs]ed?
isc           | 1 | isc      | spdx license identifier isc
isc           | 1 | fee      | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
zlib          | 2 | zlib     | zlib(?: libpng)? licen[cs]e
zlib          | 1 | altered  | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
libpng        | 2 | libpng   | libpng licen[cs]e
bsl-1.0       | 1 | boost    | boost software licen[cs]e<1>
bsl           | 2 | boost    | boost software licen[cs]e
psf-2.0       | 2 | python   | python software foundation licen[cs]e(?: version)?(?: 2)?
python-2.0    | 2 | python   | python licen[cs]e(?: version)?(?: 2 0)?
php-3.01      | 2 | php      | php licen[cs]e(?: version| v)?(?: 3 0[01]?)?
ruby          | 2 | ruby     | ruby licen[cs]e
openssl       | 2 | openssl  | openssl licen[cs]e
openldap      | 2 | openldap | openldap public licen[cs]e(?: version)?(?: 2 \d)?
postgresql    | 2 | postgresql | postgresql licen[cs]e
ncsa          | 2 | ncsa     | (?:university of illinois )?ncsa open source licen[cs]e
unicode       | 2 | unicode  | unicode (?:inc )?licen[cs]e(?: agreement)?
w3c           | 2 | w3c      | w3c software (?:notice and )?(?:and document )?licen[cs]e
curl          | 2 | curl     | curl licen[cs]e
icu           | 2 | icu      | icu licen[cs]e
ofl-1.1       | 1 | sil      | sil open font licen[cs]e<1.1>
ofl           | 2 | sil      | sil open font licen[cs]e
ofl-1.1       | 1 | ofl      | ofl<1.1>
upl-1.0       | 2 | universal | universal permissive licen[cs]e(?: v| version)?(?: 1 0)?
bluoak-1.0.0  | 2 | oak      | blue oak model licen[cs]e(?: 1 0 0)?
mulan-2.0     | 2 | mulan    | mulan permissive software licen[cs]e(?: v| version)? ?2?
hpnd          | 2 | historical | historical permission notice and disclaimer
json          | 1 | evil     | the software shall be used for good not evil
beerware      | 1 | beer     | you can buy me a beer in return
beerware      | 2 | beerware | beerware licen[cs]e
beerware      | 2 | beer     | beer ware licen[cs]e
wtfpl         | 1 | wtfpl    | wtfpl(?: licen[cs]e)?
fair          | 2 | fair     | fair licen[cs]e
vim           | 2 | vim      | vim licen[cs]e
intel         | 2 | intel    | intel open source licen[cs]e
# Public domain
unlicense     | 1 | unlicense | (?:the )?unlicense
unlicense     | 1 | unencumbered | this is free and unencumbered software released into the public domain
public-domain | 1 | domain   | (?:released|placed|dedicated|put) (?:in)?to <the>public domain
public-domain | 1 | domain   | is (?:now )?in the public domain
public-domain | 1 | domain   | public domain dedication
pddl-1.0      | 1 | pddl     | pddl(?: 1 0)?
pddl-1.0      | 2 | dedication | (?:open data commons )?public domain dedication and licen[cs]e
# Data, content and model licenses
odbl-1.0      | 1 | odbl     | odbl(?: 1 0)?
odbl          | 2 | database | (?:open data commons )?open database licen[cs]e
odc-by-1.0    | 1 | odc      | odc by(?: 1 0)?
odc-by        | 2 | commons  | open data commons attribution licen[cs]e
cdla-p-2.0    | 2 | permissive | community data license agreement permissive(?: version)?(?: [12] 0)?
cdla-s-1.0    | 2 | sharing  | community data license agreement sharing(?: version)?(?: 1 0)?
ogl-uk-3.0    | 1 | government | open government licen[cs]e<3>
ogl-uk        | 2 | government | open government licen[cs]e
etalab-2.0    | 2 | etalab   | (?:etalab )?(?:open licence|licence ouverte) (?:v |version )?[12] 0 etalab|etalab (?:open )?licen[cs]e
opl-1.0       | 2 | publication | open publication licen[cs]e(?: v| version)?(?: 1 0)?
openrail      | 1 | openrail | (?:creativeml |bigscience )?openrail(?: m)?(?: licen[cs]e)?
openrail      | 2 | responsible | responsible ai licen[cs]e
# Source available and commercial
busl-1.1      | 1 | business | business source licen[cs]e<1.1>
busl          | 2 | business | business source licen[cs]e
sspl-1.0      | 1 | sspl     | sspl(?: v)?(?:1| 1| 1 0)?
sspl          | 2 | side     | server side public licen[cs]e(?: version)?(?: 1)?
elastic-2.0   | 1 | elastic  | elastic licen[cs]e<2>
elastic       | 2 | elastic  | elastic licen[cs]e
commons-clause | 1 | clause  | commons clause(?: licen[cs]e)?(?: condition)?
polyform      | 2 | polyform | polyform (?:noncommercial|shield|perimeter|small business|strict|internal use) licen[cs]e(?: 1 0 0)?
confluent     | 2 | confluent | confluent community licen[cs]e
timescale     | 2 | timescale | timescale licen[cs]e
proprietary   | 2 | proprietary | proprietary and confidential
proprietary   | 3 | proprietary | proprietary (?:software )?licen[cs]e
eula          | 2 | eula     | end user licen[cs]e agreement(?: eula)?
eula          | 2 | user     | end user licen[cs]e agreement
# German, French and Spanish names
gpl           | 2 | öffentliche | allgemeine öffentliche gnu lizenz
gpl           | 2 | publique | licence publique générale gnu
gpl           | 2 | pública  | licencia pública general(?: de)? gnu
apache        | 2 | apache   | (?:apache lizenz|licence apache|licencia apache)(?: version)?(?: 2 0)?
mit           | 2 | mit      | (?:mit lizenz|licence mit|licencia mit)
bsd           | 2 | bsd      | (?:bsd lizenz|licence bsd|licencia bsd)
cc            | 2 | creative | (?:creative commons lizenz|licence creative commons|licencia creative commons)
public-domain | 2 | gemeinfrei | gemeinfreies? werk|ist gemeinfrei
public-domain | 2 | dominio  | (?:es|está) (?:de|en el) dominio público
# Statements that name no license
unknown       | 4 | spdx     | spdx license identifier [0-9a-z]+(?: [0-9a-z]+){0,5}
unknown       | 4 | license  | (?:licen[cs]ed|released|distributed) under (?:the )?(?:terms of (?:the )?)?(?:[^ ]+ ){1,5}license
unknown       | 4 | licence  | (?:licen[cs]ed|released|distributed) under (?:the )?(?:terms of (?:the )?)?(?:[^ ]+ ){1,5}licence
unknown       | 4 | license  | see (?:the )?(?:accompanying )?license(?: file)? for (?:details|more information|the full text)
unknown       | 4 | license  | under the terms of (?:the|this) license
"""


class Rule(NamedTuple):
    rule: int
    label: str
    priority: int
    keyword: str
    pattern: str


def _version(name: str) -> str:
    """The words of a version: "2.1" may be "2 1", "version 2 1", "v 2 1" or "v2 1"; a
    whole number may have a zero behind it."""
    words = name.replace(".", " ") if "." in name else f"{name}(?: 0)?"
    return f"(?: version| ver| v)? v?{words}"


def parsed(table: str = TABLE) -> list[Rule]:
    """The rules of a table, numbered in its order."""
    rules = []
    for line in table.splitlines():
        if not line.strip() or line.startswith("#"):
            continue
        label, priority, keyword, pattern = (part.strip() for part in line.split(" | ", 3))
        pattern = pattern.replace("<+>", "(?: of the license)?(?: or(?: at your option)?(?: any)? (?:later|newer)(?: version)?| plus)")
        pattern = pattern.replace("<the>", "(?:the )?(?:terms of the )?")
        pattern = re.sub(r"<([\dc?.]+)>", lambda m: _version(m.group(1)), pattern)
        rules.append(Rule(len(rules), label, int(priority), keyword, f"(?<= )(?:{pattern})(?= )"))
    return rules


RULES = parsed()
