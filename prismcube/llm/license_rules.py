r"""Signature rules of license_scan, by hand.

In titles, clauses and mentions a blank stands for any separators between words, and `@2.1` for a version after any
separators, with or without the word (`, version 2.1`, ` v2.1`, `-2.1`, `v2.1`); a zero at the version's end may
be missing. In addresses a dot is a dot; a scheme and www may come before, an extension or a slash after. The
keyword is a part of every match; but in addresses it begins a word there.
"""

#: label | pattern | keyword
TITLES = r"""
mit | (?:mit|expat)(?: (?:x11|x|expat|style|like|open source))? licen[cs]es? | licen
mit | licen[cs]e mit | licen
mit | x11 mit licen[cs]e | x11
mit-0 | mit(?: licen[cs]e)? no attribution(?: licen[cs]e)? | attribution
mit-0 | mit 0 licen[cs]e | mit
mit-advertising | enlightenment licen[cs]e(?: e16)? | enlightenment
x11 | (?:x11|x consortium|x window system) licen[cs]e | licen
apache-1.0 | apache(?: software)? licen[cs]e@1.0 | apache
apache-1.1 | apache(?: software)? licen[cs]e@1.1 | apache
apache-2.0 | apache(?: software| public)? licen[cs]e@2.0 | apache
apache-2.0 | apache (?:version |v ?)?2 0 licen[cs]ed? | apache
apache-2.0 | (?:asl|apl)(?: version| v)? 2 0 | asl|apl
apache-2.0 | alv2(?: 0)? | alv2
gpl-1.0 | (?:gnu )?general public licen[cs]e@1.0 | general
gpl-1.0 | (?:gnu )?gpl@1.0 | gpl
gpl-2.0 | (?:gnu )?general public licen[cs]e(?: gpl)?@2.0(?: or(?: at your option)?(?: any)? later(?: version)?)? | general
gpl-2.0 | (?:gnu )?gpl@2.0(?: or(?: any)? (?:later|newer)(?: version)?| only)? | gpl
gpl-2.0 | general public licen[cs]e as published by the free software foundation either@2.0 | foundation
gpl-2.0 | (?:either )?version 2(?: 0)? of the(?: gnu)? (?:general public licen[cs]e|gpl) | version
gpl-3.0 | (?:gnu )?general public licen[cs]e(?: gpl)?@3.0(?: or(?: at your option)?(?: any)? later(?: version)?)? | general
gpl-3.0 | (?:gnu )?gpl@3.0(?: or(?: any)? (?:later|newer)(?: version)?| only)? | gpl
gpl-3.0 | general public licen[cs]e as published by the free software foundation either@3.0 | foundation
gpl-3.0 | (?:either )?version 3(?: 0)? of the(?: gnu)? (?:general public licen[cs]e|gpl) | version
lgpl-2.0 | (?:gnu )?library general public licen[cs]e(?: lgpl)?(?:@2.0)? | library
lgpl-2.0 | (?:gnu )?lgpl@2.0 | lgpl
lgpl-2.1 | (?:gnu )?lesser general public licen[cs]e(?: lgpl)?@2.1(?: or(?: at your option)?(?: any)? later(?: version)?)? | lesser
lgpl-2.1 | (?:gnu )?lgpl@2.1(?: or(?: any)? (?:later|newer)(?: version)?| only)? | lgpl
lgpl-2.1 | (?:either )?version 2 1 of the(?: gnu)? (?:lesser general public licen[cs]e|lgpl) | version
lgpl-3.0 | (?:gnu )?lesser general public licen[cs]e(?: lgpl)?@3.0 | lesser
lgpl-3.0 | (?:gnu )?lgpl@3.0(?: or(?: any)? (?:later|newer)(?: version)?| only)? | lgpl
agpl-1.0 | affero general public licen[cs]e@1.0 | affero
agpl-3.0 | (?:gnu )?affero(?: general)? public licen[cs]e(?: agpl)?(?:@3.0)?(?: or(?: any)? later(?: version)?)? | affero
agpl-3.0 | (?:gnu )?agpl@3.0(?: or(?: any)? (?:later|newer)(?: version)?| only)? | agpl
gfdl-1.1 | (?:gnu )?free documentation licen[cs]e@1.1 | documentation
gfdl-1.2 | (?:gnu )?free documentation licen[cs]e@1.2 | documentation
gfdl-1.3 | (?:gnu )?free documentation licen[cs]e(?:@1.3)? | documentation
gfdl-1.3 | gfdl(?:@1.3)? | gfdl
classpath-exception-2.0 | (?:gnu )?classpath exception | classpath
gcc-exception-3.1 | gcc runtime library exception | runtime
bsd-1-clause | (?:bsd )?(?:1|one) clause bsd licen[cs]e | clause
bsd-2-clause | bsd (?:2|two) clause(?: simplified)?(?: licen[cs]e)? | clause
bsd-2-clause | (?:2|two) clause bsd(?: licen[cs]e)? | clause
bsd-2-clause | (?:simplified|freebsd) (?:bsd )?licen[cs]e | licen
bsd-3-clause | bsd (?:3|three) clause(?: (?:new|revised))?(?: (?:or )?(?:revised|modified))?(?: licen[cs]e)? | clause
bsd-3-clause | (?:3|three) clause bsd(?: licen[cs]e)? | clause
bsd-3-clause | (?:new|modified|revised) bsd(?: style)? licen[cs]e | bsd
bsd-3-clause-clear | (?:clear bsd|bsd 3 clause clear) licen[cs]e | clear
bsd-4-clause | bsd (?:4|four) clause(?: licen[cs]e)? | clause
bsd-4-clause | (?:(?:4|four) clause|original|old) bsd(?: style)? licen[cs]e | bsd
0bsd | (?:0|zero) clause bsd(?: licen[cs]e)? | clause
0bsd | (?:bsd (?:0|zero) clause|0bsd|free public)(?: licen[cs]e)(?: 1 0 0)? | licen
bsd-protection | bsd protection licen[cs]e | protection
isc | (?:isc|internet (?:systems|software) consortium)(?: software)? licen[cs]e | licen
mpl-1.0 | (?:mozilla public licen[cs]e(?: mpl)?|mpl)@1.0 | mpl|mozilla
mpl-1.1 | (?:mozilla public licen[cs]e(?: mpl)?|mpl)@1.1 | mpl|mozilla
mpl-2.0 | (?:mozilla public licen[cs]e(?: mpl)?|mpl)@2.0 | mpl|mozilla
npl-1.1 | netscape public licen[cs]e(?:@1.1)? | netscape
epl-1.0 | (?:eclipse public licen[cs]e(?: epl)?|epl)@1.0 | epl|eclipse
epl-2.0 | (?:eclipse public licen[cs]e(?: epl)?|epl)@2.0 | epl|eclipse
edl-1.0 | eclipse distribution licen[cs]e(?:@1.0)? | distribution
cddl-1.0 | common development and distribution licen[cs]e(?: cddl)?(?:@1.0)? | development
cddl-1.0 | cddl(?:@1.0)? | cddl
cddl-1.1 | (?:common development and distribution licen[cs]e(?: cddl)?|cddl)@1.1 | cddl|development
cpl-1.0 | common public licen[cs]e(?:@1.0)? | common
cpal-1.0 | common public attribution licen[cs]e(?:@1.0)? | attribution
ipl-1.0 | ibm public licen[cs]e(?:@1.0)? | ibm
artistic-1.0 | (?:perl )?artistic licen[cs]e@1.0 | artistic
artistic-1.0 | (?:perl artistic|artistic 1 0) licen[cs]e | artistic
artistic-2.0 | (?:the )?artistic licen[cs]e@2.0 | artistic
clartistic | clarified artistic licen[cs]e | clarified
zlib | zlib(?: libpng)? licen[cs]e | zlib
libpng | (?:libpng|png reference library) licen[cs]e(?: version 2)? | png
libtiff | libtiff licen[cs]e | libtiff
ijg | independent jpeg group(?: s)?(?: software)? licen[cs]e | jpeg
bsl-1.0 | boost(?: software)? licen[cs]e(?:@1.0)? | boost
unlicense | (?:the unlicen[cs]e(?: licen[cs]e)?|unlicen[cs]e licen[cs]e) | unlicen
wtfpl | do what the f(?:uck|\*ck) you want to public licen[cs]e(?:@2.0)? | want
wtfpl | wtfpl(?: licen[cs]e)?(?:@2.0)? | wtfpl
cc0-1.0 | (?:cc0|creative commons(?: cc)? zero)(?:@1.0)?(?: universal)?(?: public domain dedication)? | cc0|zero
cc-by-1.0 | (?:creative commons )?attribution@1.0 generic | attribution
cc-by-2.0 | (?:cc by|creative commons attribution(?: licen[cs]e)?)@2.0 | cc|creative
cc-by-2.5 | (?:cc by|creative commons attribution(?: licen[cs]e)?)@2.5 | cc|creative
cc-by-3.0 | (?:cc by|creative commons attribution(?: licen[cs]e)?)@3.0(?: (?:unported|united states|us))? | cc|creative
cc-by-4.0 | (?:cc by|creative commons attribution(?: licen[cs]e)?)@4.0(?: international)?(?: (?:public )?licen[cs]e)? | cc|creative
cc-by-sa-2.0 | (?:cc by sa|creative commons attribution share ?alike(?: licen[cs]e)?)@2.0 | cc|creative
cc-by-sa-2.5 | (?:cc by sa|creative commons attribution share ?alike(?: licen[cs]e)?)@2.5 | cc|creative
cc-by-sa-3.0 | (?:cc by sa|creative commons attribution share ?alike(?: licen[cs]e)?)@3.0(?: unported)? | cc|creative
cc-by-sa-4.0 | (?:cc by sa|creative commons attribution share ?alike(?: licen[cs]e)?)@4.0(?: international)?(?: (?:public )?licen[cs]e)? | cc|creative
cc-by-nc-2.0 | (?:cc by nc|creative commons attribution non ?commercial(?: licen[cs]e)?)@2.0 | cc|creative
cc-by-nc-3.0 | (?:cc by nc|creative commons attribution non ?commercial(?: licen[cs]e)?)@3.0(?: unported)? | cc|creative
cc-by-nc-4.0 | (?:cc by nc|creative commons attribution non ?commercial(?: licen[cs]e)?)@4.0(?: international)? | cc|creative
cc-by-nd-3.0 | (?:cc by nd|creative commons attribution no ?deriv(?:ative)?s(?: licen[cs]e)?)@3.0 | cc|creative
cc-by-nd-4.0 | (?:cc by nd|creative commons attribution no ?deriv(?:ative)?s(?: licen[cs]e)?)@4.0(?: international)? | cc|creative
cc-by-nc-sa-3.0 | (?:cc by nc sa|creative commons attribution non ?commercial share ?alike(?: licen[cs]e)?)@3.0(?: unported)? | cc|creative
cc-by-nc-sa-4.0 | (?:cc by nc sa|creative commons attribution non ?commercial share ?alike(?: licen[cs]e)?)@4.0(?: international)? | cc|creative
cc-by-nc-nd-3.0 | (?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: licen[cs]e)?)@3.0 | cc|creative
cc-by-nc-nd-4.0 | (?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: licen[cs]e)?)@4.0(?: international)? | cc|creative
odbl-1.0 | (?:odc )?open(?: data commons open)? database licen[cs]e(?: odbl)?(?:@1.0)? | database
odbl-1.0 | odbl(?:@1.0)? | odbl
odc-by-1.0 | (?:open data commons attribution licen[cs]e|odc by(?:@1.0)?) | odc|commons
pddl-1.0 | (?:(?:odc )?public domain dedication and licen[cs]e(?:@1.0)?|pddl(?:@1.0)?) | pddl|dedication
cdla-permissive-2.0 | (?:community data licen[cs]e agreement permissive|cdla permissive)@2.0 | permissive
cdla-sharing-1.0 | (?:community data licen[cs]e agreement sharing|cdla sharing)@1.0 | sharing
python-2.0 | python(?: software foundation)? licen[cs]e(?: agreement)?(?: version 2)? | python
python-2.0 | (?:psf|psfl)(?: licen[cs]e)(?: agreement)? | psf
cnri-python | cnri(?: open source)? licen[cs]e(?: agreement)? | cnri
php-3.0 | php licen[cs]e@3.0 | php
php-3.01 | php licen[cs]e(?:@3.01)? | php
zend-2.0 | zend(?: engine)? licen[cs]e(?:@2.0)? | zend
ruby | ruby(?: s)? licen[cs]e | ruby
openssl | openssl(?: and ssleay| ssleay)? licen[cs]e | openssl
ssleay | ssleay licen[cs]e | ssleay
curl | curl licen[cs]e | curl
ms-pl | (?:microsoft public licen[cs]e(?: ms pl)?|ms pl licen[cs]e) | licen
ms-rl | (?:microsoft reciprocal licen[cs]e(?: ms rl)?|ms rl licen[cs]e) | licen
ms-lpl | microsoft limited public licen[cs]e | limited
osl-2.1 | (?:open software licen[cs]e(?: osl)?|osl)@2.1 | osl|software
osl-3.0 | (?:open software licen[cs]e(?: osl)?|osl)@3.0 | osl|software
afl-2.1 | (?:academic free licen[cs]e(?: afl)?|afl)@2.1 | afl|academic
afl-3.0 | academic free licen[cs]e(?: afl)?(?:@3.0)? | academic
afl-3.0 | afl@3.0 | afl
ecl-2.0 | educational community licen[cs]e(?:@2.0)? | educational
eupl-1.1 | (?:european union public licen[cs]e(?: eupl)?|eupl)@1.1 | eupl|european
eupl-1.2 | (?:european union public licen[cs]e(?: eupl)?|eupl)(?:@1.2)? | eupl|european
cecill-2.1 | cecill(?: free software)?(?: licen[cs]e)?(?: agreement)?(?:@2.1)? | cecill
cecill-b | cecill b(?: licen[cs]e)? | cecill
cecill-c | cecill c(?: licen[cs]e)? | cecill
ncsa | (?:university of illinois )?ncsa open source licen[cs]e | ncsa
ncsa | uiuc(?: open source)? licen[cs]e | uiuc
postgresql | postgresql licen[cs]e | postgresql
ofl-1.0 | (?:sil )?(?:open font licen[cs]e(?: ofl)?|ofl)@1.0 | ofl|font
ofl-1.1 | (?:sil )?open font licen[cs]e(?: ofl)?(?:@1.1)? | font
ofl-1.1 | (?:sil )?ofl@1.1 | ofl
w3c | w3c(?: r)? software(?: notice| and document)?(?: notice)?(?: and)? licen[cs]e | w3c
upl-1.0 | universal permissive licen[cs]e(?:@1.0)? | universal
vim | (?:vim|charityware) licen[cs]e | licen
sleepycat | (?:sleepycat|berkeley db) licen[cs]e | licen
sspl-1.0 | (?:server side public licen[cs]e(?: sspl)?|sspl)(?:@1.0)? | sspl|server
busl-1.1 | (?:business source licen[cs]e(?: bsl| busl)?|busl)(?:@1.1)? | busl|business
elastic-2.0 | elastic licen[cs]e(?:@2.0)? | elastic
confluent-community-1.0 | confluent community licen[cs]e(?: agreement)?(?:@1.0)? | confluent
polyform-noncommercial-1.0 | polyform non ?commercial licen[cs]e(?:@1.0)?(?: 0)? | polyform
commons-clause | commons clause(?: licen[cs]e)?(?: condition)?(?:@1.0)? | clause
parity-7.0 | parity public licen[cs]e(?:@7.0)? | parity
mulanpsl-1.0 | mulan(?: permissive software licen[cs]e| psl)@1.0 | mulan
mulanpsl-2.0 | mulan(?: permissive software licen[cs]e| psl)(?:@2.0)? | mulan
beerware | (?:the )?beer ?ware licen[cs]e(?: revision 42)? | beer
openrail | (?:creativeml |bigscience |bigcode )?open ?rail(?: \+\+| m| s)?(?: m)?(?: licen[cs]e)? | openrail|creativeml|bigscience|bigcode|open
llama-community | llama(?: [234](?: [0-9])?)? community licen[cs]e(?: agreement)? | community
gemma | gemma terms of use | gemma
apsl-1.0 | apple public source licen[cs]e@1.0 | apple
apsl-2.0 | apple public source licen[cs]e(?:@2.0)? | apple
qpl-1.0 | (?:the )?q public licen[cs]e(?:@1.0)? | public
sissl | sun industry standards source licen[cs]e | sun
spl-1.0 | sun public licen[cs]e(?:@1.0)? | sun
lppl-1.3c | latex project public licen[cs]e(?:@1.3c?)? | latex
lppl-1.3c | lppl(?:@1.3c?)? | lppl
ftl | freetype(?: project)? licen[cs]e | freetype
imagemagick | imagemagick licen[cs]e | imagemagick
jasper-2.0 | jasper licen[cs]e(?:@2.0)? | jasper
json | (?:the )?json licen[cs]e | json
ntp | (?:ntp|network time protocol) licen[cs]e | licen
hpnd | historical permission notice and disclaimer | historical
unicode | unicode(?: terms of use| licen[cs]e(?: agreement)?(?: v3)?) | unicode
icu | icu licen[cs]e | icu
blueoak-1.0.0 | blue oak model licen[cs]e(?:@1.0)?(?: 0)? | oak
ms-eula | microsoft software licen[cs]e terms | terms
oldap-2.8 | openldap public licen[cs]e(?:@2.8)? | openldap
rpl-1.5 | reciprocal public licen[cs]e(?:@1.5)? | reciprocal
sgi-b-2.0 | sgi free software licen[cs]e b(?:@2.0)? | sgi
tcl | tcl(?: tk)? licen[cs]e | tcl
watcom-1.0 | sybase open watcom public licen[cs]e(?:@1.0)? | watcom
zpl-2.1 | (?:zope public licen[cs]e(?: zpl)?|zpl)(?:@2.1)? | zpl|zope
nasa-1.3 | nasa open source agreement(?:@1.3)? | nasa
ogl-uk-3.0 | (?:uk )?open government licen[cs]e(?:@3.0)? | government
etalab-2.0 | (?:etalab open licen[cs]e|licence ouverte(?: open licen[cs]e)?)(?:@2.0)? | licen
"""

#: label | words of the license's own text | keyword
CLAUSES = r"""
mit | permission is hereby granted(?:,)? free of charge to any person obtaining a copy of this software and associated documentation(?: files)? | obtaining
mit | the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the (?:software|materials) | substantial
mit-0 | to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided | furnished
apache-2.0 | you may not use (?:this|these) (?:file|files|work) except in compliance with the(?: apache)? licen[cs]e | compliance
apache-2.0 | unless required by applicable law or agreed to in writing(?: the)? software distributed under (?:the|this) licen[cs]e is distributed on an as is basis | applicable
apache-2.0 | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) licen[cs]e | perpetual
apache-1.1 | the end user documentation included with the redistribution if any must include the following acknowledg(?:e)?ment | redistribution
gpl | you (?:can|may) redistribute it and or modify it under the terms of the gnu general public licen[cs]e | redistribute
gpl | you should have received a copy of the gnu general public licen[cs]e along with | received
gpl | the gnu general public licen[cs]e is intended to guarantee your freedom to share and change | guarantee
gpl-3.0 | the gnu general public licen[cs]e is a free copyleft licen[cs]e for software and other kinds of works | copyleft
gpl-2.0 | the licenses for most software are designed to take away your freedom to share and change it by contrast the gnu general public licen[cs]e | designed
lgpl | you (?:can|may) redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e | redistribute
lgpl | you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e along with | received
agpl-3.0 | you (?:can|may) redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e | affero
agpl-3.0 | you should have received a copy of the gnu affero general public licen[cs]e along with | affero
gfdl-1.3 | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e | documentation
bsd | redistribution and use(?: of this software)? in source and binary forms(?: of .{1,60}?)? with or without modification(?:s)? (?:are|is) permitted provided that | redistribution
bsd | redistributions of source code must retain the(?: above)? copyright notice(?:s)? this list of conditions and the following disclaimer | redistributions
bsd | redistributions in binary form must reproduce the(?: above)? copyright notice this list of conditions and the following disclaimer | redistributions
bsd-3-clause | (?:neither the names? of .{1,160}? )?may be used to endorse or promote products derived from this software without specific prior written permission | endorse
bsd-4-clause | all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment | advertising
bsd-3-clause-clear | no express or implied licenses to any party s patent rights are granted by this licen[cs]e | patent
isc | permission to use copy modify and(?: or)? distribute this software(?: and its documentation)? for any purpose with or without fee is hereby granted | hereby
0bsd | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided | hereby
hpnd | permission to use copy modify (?:and )?distribute(?: and sell)? this software and its documentation for any purpose(?: and)?(?: without fee)? is hereby granted(?: without fee)? provided that | hereby
ntp | permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted provided that the above copyright notice | hereby
mpl-1.1 | the contents of this file are subject to the mozilla public licen[cs]e@1.1 | mozilla
mpl-2.0 | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0 | mozilla
epl | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e | eclipse
cddl-1.0 | the contents of this file are subject to the terms of the common development and distribution licen[cs]e | development
bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e | organization
bsl-1.0 | distributed under the boost software licen[cs]e version 1 0 see accompanying file | boost
zlib | this software is provided as is without any express or implied warranty in no event will the authors? be held liable for any damages arising from the use of this software | warranty
zlib | the origin of this software must not be misrepresented you must not claim that you wrote the original software | misrepresented
unlicense | this is free and unencumbered software released into the public domain | unencumbered
unlicense | anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary | compile
cc0-1.0 | to the extent possible under law (?:the author|.{1,80}?) (?:has|have) waived all copyright and related or neighbou?ring rights | waived
cc-by-4.0 | by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution(?: 4 0 international)? public licen[cs]e | exercising
wtfpl | you just do what the fuck you want to | want
beerware | as long as you retain this notice you can do whatever you want with this stuff if we meet some day | whatever
ofl-1.1 | the fonts? (?:and derivatives )?(?:however )?can(?:not)? be (?:sold|released) under any other type of licen[cs]e | font
artistic-2.0 | everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document but changing it is not allowed preamble this licen[cs]e establishes the terms under which a given free software package | establishes
postgresql | in no event shall .{1,80}? be liable to any party for direct indirect special incidental or consequential damages including lost profits arising out of the use of this software and its documentation | profits
json | the software shall be used for good not evil | evil
curl | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies | hereby
vim | there are no restrictions on distributing unmodified copies of vim | vim
public-domain | (?:is |has been )?(?:hereby )?(?:released|placed|dedicated) (?:in|into|to) the public domain | public
public-domain | this (?:file|work|code|software|program) is in the public domain | public
proprietary | unauthori[sz]ed copying of this file via any medium is strictly prohibited | unauthori
proprietary | (?:proprietary and confidential|confidential and proprietary(?: information)?)(?: of)? | proprietary
proprietary | may not be (?:copied|reproduced|distributed|disclosed) (?:or (?:copied|reproduced|distributed|disclosed) )?without (?:the )?(?:express |prior )?(?:written )?(?:permission|consent) | without
"""

#: label | address | keyword
ADDRESSES = r"""
mit | opensource.org/licenses?/mit(?:-license)? | opensource.org
mit | mit-license.org | mit-license.org
mit | spdx.org/licenses/mit | spdx.org
mit-0 | opensource.org/licenses?/mit-0 | opensource.org
mit-0 | github.com/aws/mit-0 | mit-0
x11 | xfree86.org/3.3.6/copyright2.html#3 | xfree86.org
apache-1.0 | apache.org/licenses/license-1.0 | apache.org
apache-1.1 | (?:apache.org/licenses/license-1.1|opensource.org/licenses/apache-1.1) | .org
apache-2.0 | apache.org/licenses/(?:license-2.0|apache-2.0) | apache.org
apache-2.0 | (?:opensource.org|spdx.org)/licenses?/apache(?:license)?-?2.0 | .org/licen
gpl | gnu.org/(?:licenses/|copyleft/)gpl | gnu.org
gpl-1.0 | gnu.org/licenses/(?:old-licenses/)?gpl-1.0(?:-standalone)? | gnu.org
gpl-2.0 | gnu.org/licenses/(?:old-licenses/)?gpl-2.0(?:-standalone)? | gnu.org
gpl-2.0 | opensource.org/licenses?/gpl-2.0 | opensource.org
gpl-3.0 | gnu.org/licenses/gpl-3.0(?:-standalone)? | gnu.org
gpl-3.0 | opensource.org/licenses?/gpl-3.0 | opensource.org
lgpl | gnu.org/(?:licenses/|copyleft/)(?:lgpl|lesser) | gnu.org
lgpl-2.0 | gnu.org/licenses/old-licenses/lgpl-2.0(?:-standalone)? | gnu.org
lgpl-2.1 | gnu.org/licenses/(?:old-licenses/)?lgpl-2.1(?:-standalone)? | gnu.org
lgpl-3.0 | gnu.org/licenses/lgpl-3.0(?:-standalone)? | gnu.org
agpl-3.0 | gnu.org/licenses/agpl(?:-3.0)?(?:-standalone)? | gnu.org
gfdl-1.3 | gnu.org/(?:licenses/|copyleft/)fdl(?:-1.3)? | gnu.org
bsd | opensource.org/licenses?/bsd-license | opensource.org
bsd-2-clause | (?:opensource.org|spdx.org)/licenses?/bsd-2-clause | bsd-2
bsd-3-clause | (?:opensource.org|spdx.org)/licenses?/bsd-3-clause | bsd-3
0bsd | opensource.org/licenses?/0bsd | 0bsd
isc | opensource.org/licenses?/isc(?:-license)? | opensource.org
mpl-1.1 | mozilla.org/(?:en-us/)?mpl/(?:mpl-)?1.1 | mozilla.org
mpl-2.0 | mozilla.org/(?:en-us/)?mpl/2.0 | mozilla.org
mpl-2.0 | opensource.org/licenses?/mpl-2.0 | opensource.org
epl-1.0 | (?:eclipse.org/(?:legal|org/documents)/epl-v10|opensource.org/licenses?/epl-1.0) | .org
epl-2.0 | (?:eclipse.org/(?:legal|org/documents)/epl-(?:2.0|v20)|opensource.org/licenses?/epl-2.0) | .org
cddl-1.0 | opensource.org/licenses?/cddl-?1(?:.0)? | opensource.org
cddl-1.1 | glassfish.java.net/public/cddl\+gpl_1_1 | glassfish
cpl-1.0 | opensource.org/licenses?/cpl1.0 | opensource.org
ipl-1.0 | opensource.org/licenses?/ibmpl | opensource.org
artistic-1.0 | opensource.org/licenses?/artistic-license-1.0 | artistic
artistic-2.0 | (?:opensource.org/licenses?/artistic-(?:license-)?2.0|perlfoundation.org/artistic_license_2_0) | artistic
zlib | (?:opensource.org/licenses?/zlib(?:-license)?|zlib.net/zlib_license) | zlib
libpng | libpng.org/pub/png/src/libpng-license | libpng.org
bsl-1.0 | (?:boost.org/license_1_0|opensource.org/licenses?/bsl-1.0) | .org
unlicense | unlicense.org | unlicense.org
wtfpl | (?:wtfpl.net|sam.zoy.org/wtfpl) | wtfpl
cc0-1.0 | creativecommons.org/publicdomain/zero/1.0 | creativecommons.org
public-domain | creativecommons.org/publicdomain/mark/1.0 | creativecommons.org
cc-by-3.0 | creativecommons.org/licenses/by/3.0 | creativecommons.org
cc-by-4.0 | creativecommons.org/licenses/by/4.0 | creativecommons.org
cc-by-sa-3.0 | creativecommons.org/licenses/by-sa/3.0 | creativecommons.org
cc-by-sa-4.0 | creativecommons.org/licenses/by-sa/4.0 | creativecommons.org
cc-by-nc-3.0 | creativecommons.org/licenses/by-nc/3.0 | creativecommons.org
cc-by-nc-4.0 | creativecommons.org/licenses/by-nc/4.0 | creativecommons.org
cc-by-nd-4.0 | creativecommons.org/licenses/by-nd/4.0 | creativecommons.org
cc-by-nc-sa-4.0 | creativecommons.org/licenses/by-nc-sa/4.0 | creativecommons.org
cc-by-nc-nd-4.0 | creativecommons.org/licenses/by-nc-nd/4.0 | creativecommons.org
creative-commons | creativecommons.org/licenses/by(?:-nc)?(?:-sa|-nd)?/[12].[05] | creativecommons.org
odbl-1.0 | opendatacommons.org/licenses/odbl(?:/(?:1-0|1.0))? | opendatacommons.org
odc-by-1.0 | opendatacommons.org/licenses/by(?:/(?:1-0|1.0))? | opendatacommons.org
pddl-1.0 | opendatacommons.org/licenses/pddl(?:/(?:1-0|1.0))? | opendatacommons.org
python-2.0 | (?:docs.python.org/[0-9.]+/license|python.org/psf/license) | python.org
php-3.01 | php.net/license/3_01 | php.net
ruby | ruby-lang.org/en/about/license | ruby-lang.org
openssl | openssl.org/source/license | openssl.org
ofl-1.1 | (?:scripts.sil.org/ofl|openfontlicense.org|opensource.org/licenses?/ofl-1.1) | ofl|openfont
w3c | w3.org/consortium/legal/(?:20[0-9]+/)?copyright-software(?:-[0-9]+)? | w3.org
upl-1.0 | (?:oss.oracle.com/licenses/upl|opensource.org/licenses?/upl) | upl
sspl-1.0 | mongodb.com/licensing/server-side-public-license | mongodb.com
busl-1.1 | mariadb.com/bsl11 | mariadb.com
elastic-2.0 | elastic.co/licensing/elastic-license | elastic.co
mulanpsl-2.0 | license.coscl.org.cn/mulanpsl2 | coscl
beerware | people.freebsd.org/~phk | freebsd.org
openrail | huggingface.co/spaces/bigscience/license | huggingface.co
eupl-1.2 | joinup.ec.europa.eu/(?:collection/eupl|software/page/eupl) | joinup
lppl-1.3c | latex-project.org/lppl(?:/lppl-1-3c)? | latex-project
blueoak-1.0.0 | blueoakcouncil.org/license/1.0.0 | blueoak
llama-community | llama.meta.com/(?:llama[0-9_]*/)?license | llama
etalab-2.0 | etalab.gouv.fr/licence-ouverte-open-licence | etalab
"""

#: label | mention without version | keyword
MENTIONS = r"""
gpl | gnu gpl | gpl
gpl | gpl(?:ed)? licen[cs](?:e|ed) | gpl
lgpl | gnu lgpl | lgpl
lgpl | (?:gnu )?lesser general public licen[cs]e | lesser
agpl-3.0 | gnu agpl | agpl
apache | apache licensed | apache
bsd | bsd(?: style| type| like)? licen[cs](?:e|ed) | bsd
mit | mit licensed | licensed
artistic | artistic licen[cs]e | artistic
cc-by | cc by(?: n[cd]| sa){0,2} | cc
creative-commons | creative commons(?: licen[cs]e)? | creative
public-domain | public domain | public
proprietary | all rights reserved | reserved
proprietary | proprietary licen[cs]e | proprietary
mpl | mozilla public licen[cs]e | mozilla
epl | eclipse public licen[cs]e | eclipse
osl | open software licen[cs]e | software
"""

#: label | identifiers
IDENTIFIERS = """
mit | mit
mit-0 | mit-0
x11 | x11
apache-1.0 | apache-1.0
apache-1.1 | apache-1.1
apache-2.0 | apache-2.0
gpl-1.0 | gpl-1.0, gpl-1.0-only, gpl-1.0-or-later
gpl-2.0 | gpl-2.0, gpl-2.0-only, gpl-2.0-or-later
gpl-3.0 | gpl-3.0, gpl-3.0-only, gpl-3.0-or-later
lgpl-2.0 | lgpl-2.0, lgpl-2.0-only, lgpl-2.0-or-later
lgpl-2.1 | lgpl-2.1, lgpl-2.1-only, lgpl-2.1-or-later
lgpl-3.0 | lgpl-3.0, lgpl-3.0-only, lgpl-3.0-or-later
agpl-1.0 | agpl-1.0, agpl-1.0-only, agpl-1.0-or-later
agpl-3.0 | agpl-3.0, agpl-3.0-only, agpl-3.0-or-later
gfdl-1.2 | gfdl-1.2, gfdl-1.2-only, gfdl-1.2-or-later
gfdl-1.3 | gfdl-1.3, gfdl-1.3-only, gfdl-1.3-or-later
bsd-1-clause | bsd-1-clause
bsd-2-clause | bsd-2-clause
bsd-3-clause | bsd-3-clause
bsd-3-clause-clear | bsd-3-clause-clear
bsd-4-clause | bsd-4-clause
0bsd | 0bsd
isc | isc
mpl-1.0 | mpl-1.0
mpl-1.1 | mpl-1.1
mpl-2.0 | mpl-2.0, mpl-2.0-no-copyleft-exception
epl-1.0 | epl-1.0
epl-2.0 | epl-2.0
cddl-1.0 | cddl-1.0
cddl-1.1 | cddl-1.1
cpl-1.0 | cpl-1.0
ipl-1.0 | ipl-1.0
artistic-1.0 | artistic-1.0, artistic-1.0-perl
artistic-2.0 | artistic-2.0
zlib | zlib
libpng | libpng, libpng-2.0
bsl-1.0 | bsl-1.0
unlicense | unlicense
wtfpl | wtfpl
cc0-1.0 | cc0-1.0
cc-by-3.0 | cc-by-3.0
cc-by-4.0 | cc-by-4.0
cc-by-sa-3.0 | cc-by-sa-3.0
cc-by-sa-4.0 | cc-by-sa-4.0
cc-by-nc-3.0 | cc-by-nc-3.0
cc-by-nc-4.0 | cc-by-nc-4.0
cc-by-nd-4.0 | cc-by-nd-4.0
cc-by-nc-sa-4.0 | cc-by-nc-sa-4.0
cc-by-nc-nd-4.0 | cc-by-nc-nd-4.0
odbl-1.0 | odbl-1.0
odc-by-1.0 | odc-by-1.0
pddl-1.0 | pddl-1.0
python-2.0 | python-2.0, psf-2.0
php-3.01 | php-3.01
ruby | ruby
openssl | openssl
ms-pl | ms-pl
ms-rl | ms-rl
osl-3.0 | osl-3.0
afl-3.0 | afl-3.0
ecl-2.0 | ecl-2.0
eupl-1.2 | eupl-1.2
ncsa | ncsa
postgresql | postgresql
ofl-1.1 | ofl-1.1, ofl-1.1-rfn, ofl-1.1-no-rfn
w3c | w3c, w3c-20150513
upl-1.0 | upl-1.0
vim | vim
sleepycat | sleepycat
sspl-1.0 | sspl-1.0
busl-1.1 | busl-1.1
elastic-2.0 | elastic-2.0
mulanpsl-2.0 | mulanpsl-2.0
beerware | beerware
openrail | creativeml-openrail-m, bigscience-openrail-m
json | json
curl | curl
hpnd | hpnd
blueoak-1.0.0 | blueoak-1.0.0
"""
