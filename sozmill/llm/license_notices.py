"""Notices, addresses, expressions and text passages of licenses, as rules written one by one.

Each is ``label, keyword, words``: a regular expression over lower-case words joined by
single spaces, every reading of which has the keyword as a word.
"""

# SPDX expressions of more than one part.
EXPRESSIONS = (
    ("mit-or-apache-2.0", "spdx", "spdx license identifier (?:mit or apache 2 0|apache 2 0 or mit)"),
    ("mit-and-bsd-3-clause", "spdx", "spdx license identifier (?:mit and bsd 3 clause|bsd 3 clause and mit)"),
    ("gpl-2.0-or-mit", "spdx", "spdx license identifier (?:gpl 2 0(?: only| or later)? or mit|mit or gpl 2 0(?: only| or later)?)"),
    ("gpl-2.0-or-bsd-2-clause", "spdx", "spdx license identifier (?:gpl 2 0(?: only| or later)? or bsd 2 clause|bsd 2 clause or gpl 2 0)"),
    ("gpl-2.0-or-bsd-3-clause", "spdx", "spdx license identifier (?:gpl 2 0(?: only| or later)? or bsd 3 clause|bsd 3 clause or gpl 2 0)"),
    ("lgpl-2.1-or-mpl-1.1", "spdx", "spdx license identifier (?:lgpl 2 1(?: only| or later)? or mpl 1 1|mpl 1 1 or lgpl 2 1)"),
    ("mpl-1.1-or-gpl-2.0-or-lgpl-2.1", "spdx", "spdx license identifier mpl 1 1 or gpl 2 0(?: or later)? or lgpl 2 1"),
    ("gpl-2.0-with-linux-syscall-note", "spdx", "spdx license identifier gpl 2 0(?: only| or later)? with linux syscall note"),
    ("gpl-2.0-with-classpath-exception", "spdx", "spdx license identifier gpl 2 0(?: only| or later)? with classpath exception"),
    ("gpl-2.0-with-autoconf-exception", "spdx", "spdx license identifier gpl [23] 0(?: only| or later)? with autoconf exception"),
    ("gpl-2.0-with-bison-exception", "spdx", "spdx license identifier gpl [23] 0(?: only| or later)? with bison exception"),
    ("gpl-3.0-with-gcc-exception", "spdx", "spdx license identifier gpl 3 0(?: only| or later)? with gcc exception"),
    ("lgpl-3.0-with-linking-exception", "spdx", "spdx license identifier lgpl 3 0(?: only| or later)? with lgpl 3 0 linking exception"),
    ("apache-2.0-with-llvm-exception", "spdx", "spdx license identifier apache 2 0 with llvm exception"),
    ("epl-2.0-or-gpl-2.0", "spdx", "spdx license identifier epl 2 0 or gpl 2 0"),
    ("cc0-1.0", "spdx", "spdx license identifier cc0 1 0"),
)

# Notices at the head of files.
NOTICES = (
    ("gpl-2.0", "gnu", "gnu general public license as published by the free software foundation either version 2(?: of the license)? or (?:at your option )?any later version"),
    ("gpl-3.0", "gnu", "gnu general public license as published by the free software foundation either version 3(?: of the license)? or (?:at your option )?any later version"),
    ("gpl-2.0", "gnu", "gnu general public license version 2(?: only)? as published by the free software foundation"),
    ("gpl-3.0", "gnu", "gnu general public license version 3(?: only)? as published by the free software foundation"),
    ("lgpl-2.0", "library", "gnu library general public license as published by the free software foundation either version 2(?: of the license)? or (?:at your option )?any later version"),
    ("lgpl-2.1", "lesser", "gnu lesser general public license as published by the free software foundation either version 2 1(?: of the license)? or (?:at your option )?any later version"),
    ("lgpl-3.0", "lesser", "gnu lesser general public license as published by the free software foundation either version 3(?: of the license)? or (?:at your option )?any later version"),
    ("lgpl-2.1", "lesser", "gnu lesser general public license version 2 1(?: only)? as published by the free software foundation"),
    ("agpl-3.0", "affero", "gnu affero general public license as published by the free software foundation either version 3(?: of the license)? or (?:at your option )?any later version"),
    ("agpl-3.0", "affero", "gnu affero general public license version 3(?: only)? as published by the free software foundation"),
    ("gfdl", "documentation", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gpl", "gnu", "you should have received a copy of the gnu general public license along with this (?:program|library|file|software|package)"),
    ("lgpl", "lesser", "you should have received a copy of the gnu lesser general public license along with this (?:program|library|file|software|package)"),
    ("lgpl", "library", "you should have received a copy of the gnu library general public license along with this (?:program|library|file|software|package)"),
    ("agpl", "affero", "you should have received a copy of the gnu affero general public license along with this (?:program|library|file|software|package)"),
    ("apache-2.0", "apache", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", "asf", "the asf licenses this file to you under the apache license version 2 0"),
    ("apache-2.0", "governing", "see the license for the specific language governing permissions and limitations under the license"),
    ("mpl-2.0", "mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-2.0", "secondary", "this source code form is incompatible with secondary licenses as defined by the mozilla public license v 2 0"),
    ("epl-1.0", "eclipse", "accompanying materials are made available under the terms of the eclipse public license (?:v |version )?1 0"),
    ("epl-2.0", "eclipse", "accompanying materials are made available under the terms of the eclipse public license (?:v |version )?2 0"),
    ("cddl-1.0", "development", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("bsl-1.0", "boost", "use modification and distribution are subject to the boost software license version 1 0"),
    ("bsd", "bsd", "use of this source code is governed by a bsd style license that can be found in the license file"),
    ("mit", "mit", "use of this source code is governed by an? mit style license that can be found in the license file"),
    ("apache-2.0", "apache", "use of this source code is governed by the apache 2 0 license that can be found in the license file"),
    ("perl", "perl", "you (?:can|may) redistribute it and or modify it under the same terms as perl itself"),
    ("ruby", "ruby", "you can redistribute it and or modify it under the terms of ruby s license"),
    ("eupl-1.2", "eupl", "licensed under the eupl version 1 2(?: only)? or as soon they will be approved by the european commission subsequent versions"),
    ("cc0-1.0", "waived", "to the extent possible under law (?:[^ ]+ ){1,6}(?:has|have) waived all copyright and related or neighboring rights"),
    ("cc0-1.0", "dedicated", "to the extent possible under law (?:[^ ]+ ){1,6}(?:has|have) dedicated all copyright and related and neighboring rights"),
    ("public-domain", "disclaims", "the author(?: hereby)? disclaims copyright to this source code"),
    ("public-domain", "domain", "this (?:file|work|program|software|code) is (?:hereby )?in the public domain"),
    ("public-domain", "domain", "(?:placed|released|put|dedicated) (?:in|into|to) the public domain by"),
    ("proprietary", "confidential", "this software is the confidential and proprietary information of"),
    ("proprietary", "unauthorized", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "reproduced", "no part of this (?:publication|document|work|book|site) may be reproduced"),
    ("proprietary", "redistribution", "this (?:file|document|text|software) is not for redistribution"),
)

# Addresses, their points and strokes being gaps between words.
ADDRESSES = (
    ("gpl-2.0", "gnu", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3.0", "gnu", "gnu org licenses gpl 3 0"),
    ("gpl", "gnu", "gnu org (?:copyleft|licenses) gpl"),
    ("lgpl-2.1", "gnu", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "gnu", "gnu org licenses lgpl 3 0"),
    ("lgpl", "gnu", "gnu org (?:copyleft|licenses) lgpl"),
    ("agpl-3.0", "gnu", "gnu org licenses agpl(?: 3 0)?"),
    ("gfdl", "gnu", "gnu org (?:copyleft|licenses) fdl"),
    ("apache-2.0", "apache", "apache org licenses license 2 0"),
    ("apache-1.1", "apache", "apache org licenses license 1 1"),
    ("mpl-2.0", "mozilla", "mozilla org (?:en us )?mpl 2 0"),
    ("mpl-1.1", "mozilla", "mozilla org mpl mpl 1 1"),
    ("epl-1.0", "eclipse", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", "eclipse org legal epl (?:2 0|v20)"),
    ("bsl-1.0", "boost", "boost org license 1 0"),
    ("ofl", "sil", "scripts sil org ofl"),
    ("unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "wtfpl", "wtfpl net"),
    ("eupl", "eupl", "joinup ec europa eu (?:[^ ]+ ){0,6}eupl"),
    ("mit", "opensource", "opensource org licenses? mit"),
    ("isc", "opensource", "opensource org licenses? isc"),
    ("zlib", "opensource", "opensource org licenses? zlib"),
    ("bsd-2-clause", "opensource", "opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "opensource", "opensource org licenses? bsd 3 clause"),
    ("apache-2.0", "opensource", "opensource org licenses? apache 2 0"),
    ("mpl-2.0", "opensource", "opensource org licenses? mpl 2 0"),
    ("artistic-2.0", "opensource", "opensource org licenses? artistic (?:license )?2 0"),
    ("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("public-domain", "creativecommons", "creativecommons org publicdomain mark 1 0"),
    ("cc-by-4.0", "creativecommons", "creativecommons org licenses by 4 0"),
    ("cc-by-sa-4.0", "creativecommons", "creativecommons org licenses by sa 4 0"),
    ("cc-by-nd-4.0", "creativecommons", "creativecommons org licenses by nd 4 0"),
    ("cc-by-nc-4.0", "creativecommons", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-sa-4.0", "creativecommons", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "creativecommons", "creativecommons org licenses by nc nd 4 0"),
    ("cc-by-3.0", "creativecommons", "creativecommons org licenses by 3 0"),
    ("cc-by-sa-3.0", "creativecommons", "creativecommons org licenses by sa 3 0"),
    ("cc-by-nc-3.0", "creativecommons", "creativecommons org licenses by nc 3 0"),
    ("cc-by-nc-sa-3.0", "creativecommons", "creativecommons org licenses by nc sa 3 0"),
    ("odbl-1.0", "opendatacommons", "opendatacommons org licenses odbl"),
)

# Exceptions to other licenses.
EXCEPTIONS = (
    ("classpath-exception", "independent", "permission to link this library with independent modules to produce an executable"),
    ("gcc-exception", "gcc", "gcc runtime library exception"),
    ("autoconf-exception", "autoconf", "contains a configuration script generated by autoconf you may include it under the same distribution terms"),
    ("bison-exception", "bison", "you may create a larger work that contains part or all of the bison parser skeleton"),
    ("openssl-exception", "openssl", "permission to link the code of portions of this program with the openssl library"),
    ("linux-syscall-note", "kernel", "this copyright does not cover user programs that use kernel services by normal system calls"),
    ("llvm-exception", "compiling", "as an exception if as a result of your compiling your source code portions of this software are embedded"),
    ("font-exception", "font", "if you create a document which uses this font and embed this font or unaltered portions of this font"),
    ("wxwindows-exception", "wxwindows", "wxwindows library licen[sc]e"),
    ("qt-lgpl-exception", "qt", "qt (?:company )?lgpl exception"),
    ("commons-clause", "commons", "commons clause license condition"),
)

# Passages that only the text of one license has.
PASSAGES = (
    ("gpl", "freedom", "the licenses for most software(?: and other practical works)? are designed to take away your freedom"),
    ("gpl-2.0", "june", "gnu general public license version 2 june 1991"),
    ("gpl-3.0", "june", "gnu general public license version 3 29 june 2007"),
    ("lgpl-2.1", "february", "gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3.0", "june", "gnu lesser general public license version 3 29 june 2007"),
    ("agpl-3.0", "november", "gnu affero general public license version 3 19 november 2007"),
    ("gfdl-1.3", "november", "gnu free documentation license version 1 3 3 november 2008"),
    ("gnu-warranty", "hope", "is distributed in the hope that it will be useful but without any warranty"),
    ("apache-2.0", "january", "apache license version 2 0 january 2004"),
    ("apache-1.1", "apache", "this product includes software developed by the apache software foundation"),
    ("artistic-2.0", "perl", "artistic license 2 0 copyright c 2000 2006 the perl foundation"),
    ("ofl-1.1", "february", "sil open font license version 1 1 26 february 2007"),
    ("ms-pl", "accompanying", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("wtfpl", "december", "do what the fuck you want to public license version 2 december 2004"),
    ("mit", "substantial", "this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "merchantability", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions"),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright notice this list of conditions"),
    ("bsd-3-clause", "endorse", "neither the name of (?:[^ ]+ ){1,8}nor the names of (?:its|their) contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("isc", "fee", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", "sell", "permission to use copy modify (?:and )?distribute and sell this software and its documentation for any purpose is hereby granted without fee"),
    ("postgresql", "agreement", "this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("tcl", "authors", "the authors hereby grant permission to use copy modify distribute and license this software"),
    ("x11", "consortium", "except as contained in this notice the name of the x consortium shall not be used"),
    ("ncsa", "ncsa", "university of illinois ncsa open source license"),
    ("unicode", "unicode", "obtaining a copy of the unicode data files"),
    ("openssl", "openssl", "this product includes software developed by the openssl project"),
    ("ssleay", "cryptographic", "this product includes cryptographic software written by eric young"),
    ("ijg", "jpeg", "this software is based in part on the work of the independent jpeg group"),
    ("freetype", "freetype", "portions of this software are copyright (?:[^ ]+ ){1,4}the freetype project"),
    ("json", "evil", "the software shall be used for good not evil"),
    ("beerware", "beer", "if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("unlicense", "compile", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("sspl-1.0", "server", "server side public license(?: version 1)?"),
    ("busl-1.1", "business", "business source license 1 1"),
    ("elastic-2.0", "elastic", "elastic license (?:version )?2 0"),
    ("polyform-noncommercial", "polyform", "polyform noncommercial license 1 0 0"),
    ("vim", "vim", "vim license"),
    ("mit-0", "attribution", "mit no attribution(?: license)?"),
    ("python-2.0", "psf", "this license agreement is between the python software foundation psf"),
    ("php-3.01", "php", "the php license version 3 01"),
    ("zpl-2.1", "zope", "zope public license zpl version 2 1"),
    ("odc-by-1.0", "attribution", "open data commons attribution license"),
    ("pddl-1.0", "dedication", "open data commons public domain dedication and licen[sc]e"),
)
