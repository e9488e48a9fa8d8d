"""Fixed values of the quality metrics: word and phrase lists."""

from __future__ import annotations

# Function words counted as stopwords, in their usual order. An entry with an apostrophe never matches a token.
STOPWORDS = """
ha
pe
upe
upéva
upeva
re
ne
nde
ore
ñande
kuéra
kuera
ramo
jave
rire
niko
piko
ningo
hína
hina
va
vaʼekue
va'ekue
haguã
hagua
guarã
guara
guive
peve
rupi
gui
py
de
del
al
la
el
los
las
le
un
uno
una
e
o
a
que
en
por
para
con
se
sí
no
su
""".split()

# Offensive phrases, in their usual order; entries that stand twice count twice.
BAD_WORDS = """
ajapiro imátare
akakapátama akuaruségui
akãne
akãnguasu tepoti tenonde
tekaka la eréa
tembo la eréa
akã pekõi
akã trapo
akuarupátama akakaségui
añamechũmeguare
añamechũrépeguare
añamemby
añaraitypeguare
añarakáipeguare
añarakikua
añarakikuárapeguare
añarakikuápeguare
añarako
añarakokua
añarakokuapytã’ikuárapeguare
añarakópeguare
añarapypikuarapeguare
anguja tupao
arpa forro
arriero akãperõ avatisoka
arriero hũ eíra barato
arriero karape ñati’ũ silleta
arriero revikuapo’i kururu piru
arriero sãmbyky kure patada
arriero tavy vaka cháko
arriero vai kururu ñembo’y
bola saingo
chalái
che rako
che rakokua
che rembo
che revi
che revikuápe
edobla ha eguapy hi’ári
eikéna nderevikuápe
eike nderevikuápe
eike nde revikuápe
eike nde siétepe
ejapiro
ejapiro imátare
ejapiro túnare
ekañýna nde tembo
tembo
temborako
emoĩ nde jurúre pañal porque tekaka la eréa
g̃uaig̃ui kasõ
g̃uaig̃ui tuja
g̃uaig̃ui vai estribo yvyra
guyra tavy
haikue vóllo
ha la che he’i itatunéa
ijargelkaka
ivaive kururu aborto-gui
jagua karẽ’i
jaguakuña
jagua mondaha
jaguary’ái
jaguatĩ
jagua to’u nde vóla
japiro
juru palangana
jurutavy
kelembu
kuña revi hu’ũ mamóne
kuña’i
lápi mbyky
lorito óga
mbarakaja kasõ
mba’e akãperõ che rembo akã
mba’éiko nde tembo rako reikóa
mba’éiko nde tembo rova reikóa
mba’épio la re’uséva nde rova tembo
mba’e syva perõ che tatu
mbóre
mborefliki
mbusia cargado
mitã’i chavi
mitã’i charráki
mitã’i piru
mitã’i tepoti
molde vai
molde vai arpa ryru
molde vai úra
mondaha
mostruo rupi’a
mykurẽ
mba’e hũ ólla revi
mba’e jurune escopeta caño
mba’e rova simple mandi’o rykue
ñati’ũ bikini
nde akã tembo
nde mba’e jurune water
nderakokánto
nderasóre
nderevi
nde revikua
ñeretĩri
ñe’ẽrei
ñe’ẽ tavy
ohesyvõ chupe
okuarupáta nderehe
omoñapymi tevi rague
oñoña chupe
opoi kuártagui
tekove arruinado
tekove infeli
che rembo pire
pilili
pire pererĩ
piru osamenta
pituva
pokarẽ
poky’a
popinda
púto repoti
púto tuja
púto uha
añarakokũ
añamemby rako pútapeguare
pychãi
pychi’ĩ
pysã tronco
tevine, revine, hevine
roinupãta ne kangue ine meve
rombopopegua atãporãtahína
sapatu un lado
sevo’i eléctrico
tako chalái
tako cha’ĩ
takuchi
takuchíla
takuchílo
takúlo, takúla
takúlo capitán
tatune
tavy
tavyrai
tavyrón
tejulele
tekaka la eréa
tekove hũ carbón
tembo chóto
tembo forro
tembo la eréa
tembo la eréva
tembo nde’áva
tembone
tembo rakópe guare
tepoti piru de 3 diáicha neryakuã asy
tepoti tenonde
terehóna embojahu pira mba’e
tevi chi’ĩ
tevijepiro
tevi locote
tevine
tevipicha’ĩ kangy
teviro
tĩkaguare
tilinga
tĩro’ysã
tóro rembo
vaikuéto
vaka cháko
vare’a
voli kuña
výro
vyrochúko
vaícha
púto tuja
""".strip().split("\n")

# Phrases of legal notices.
LEGAL_PHRASES = """
terms of use
privacy policy
cookie policy
uses cookies
use of cookies
use cookies
términos de uso
politica de privacidad
política de privacidad
politica de cookies
política de cookies
usa cookies
uso de cookies
cookies jeporu
ñe’ẽme’ẽ jepururã
cookies rehegua marandu
oipuru cookies
cookies jeporu
ojepuru cookies
""".strip().split("\n")
