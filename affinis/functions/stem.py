"""Suffix-stripping stems for Portuguese words.

Rules in the order of the published algorithm (Orengo and Huyck, 2001): within a
step the first rule applies whose suffix fits and leaves a long enough stem.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values, one rule to a line: suffix, shortest stem, replacement (-: none), words the rule leaves alone.
PLURAL = """
ns 1 m
ões 3 ão
ães 1 ão mães
ais 1 al cais mais
éis 2 el
eis 2 el
óis 2 ol
is 2 il lápis cais mais crúcis biquínis pois depois dois leis
les 3 l
res 3 r
s 2 - aliás pires lápis cais mais mas menos férias fezes pêsames crúcis gás atrás moisés através convés ês país após ambas ambos messias
"""
FEMININE = """
ona 3 ão abandona lona iona cortisona monótona maratona acetona detona carona
ora 3 or
na 4 no carona abandona lona iona cortisona monótona maratona acetona detona guiana campana grana caravana banana paisana
inha 3 inho rainha linha minha
esa 3 ês mesa obesa princesa turquesa ilesa pesa presa
osa 3 oso mucosa prosa
íaca 3 íaco
ica 3 ico dica
ada 2 ado pitada
ida 3 ido vida
ída 3 ido recaída saída dúvida
ima 3 imo vítima
iva 3 ivo saliva oliva
eira 3 eiro beira cadeira frigideira bandeira feira capoeira barreira fronteira besteira poeira
ã 2 ão amanhã arapuã fã divã
"""
AUGMENTATIVE = """
díssimo 5 -
abilíssimo 5 -
íssimo 3 -
ésimo 3 -
érrimo 4 -
zinho 2 -
quinho 4 c
uinho 4 -
adinho 3 -
inho 3 - caminho cominho
alhão 4 -
uça 4 -
aço 4 - antebraço
adão 4 -
ázio 3 - topázio
arraz 4 -
arra 3 -
zão 2 - coalizão
ão 3 - camarão chimarrão canção coração embrião grotão glutão ficção fogão feição furacão gamão lampião leão macacão nação órfão orgão patrão portão quinhão rincão tração falcão espião mamão folião cordão aptidão campeão colchão limão leilão melão barão milhão bilhão fusão cristão ilusão capitão estação senão
"""
ADVERB = """
mente 4 - experimente
"""
NOUN = """
encialista 4 -
alista 5 -
agem 3 - coragem chantagem vantagem carruagem
iamento 4 -
amento 3 - firmamento fundamento departamento
imento 3 -
alizado 4 -
atizado 4 -
izado 5 - organizado pulverizado
ativo 4 - pejorativo relativo
tivo 4 - relativo
ivo 4 - passivo possessivo pejorativo positivo
ado 2 - grado
ido 3 - cândido consolido rápido decido tímido duvido marido
ador 3 -
edor 3 -
idor 4 - ouvidor
atória 5 -
or 2 - motor melhor redor rigor sensor tambor tumor assessor benfeitor pastor terior favor autor
abilidade 5 -
icionista 4 -
cionista 5 -
ional 4 -
ência 3 -
ância 4 - ambulância
edouro 3 -
queiro 3 c
eiro 3 - desfiladeiro pioneiro mosteiro
oso 3 - precioso
alizaç 5 -
ismo 3 - cinismo
izaç 5 - organizaç
aç 3 - equaç relaç
iç 3 - eleiç
ário 3 - voluntário salário aniversário diário lionário armário
ério 6 -
ês 4 -
eza 3 -
ez 4 -
esco 4 -
ante 2 - gigante elefante adiante possante instante restaurante
ástico 4 - eclesiástico
ático 3 -
ico 4 - tico público explico
ividade 5 -
idade 4 - autoridade comunidade
oria 4 - categoria
encial 5 -
ista 4 -
quice 4 c
ice 4 - cúmplice
íaco 3 -
ente 4 - freqüente alimente acrescente permanente oriente aparente
inal 3 - afinal
ano 4 -
ável 2 - afável razoável potável vulnerável
ível 3 - possível
ual 3 - bissexual virtual visual pontual
ial 3 -
al 4 - afinal animal estatal bissexual desleal fiscal formal pessoal liberal postal virtual visual pontual sideral sucursal
"""
VERB = """
aríamo 2 -
ássemo 2 -
eríamo 2 -
êssemo 2 -
iríamo 3 -
íssemo 3 -
áramo 2 -
árei 2 -
aremo 2 -
ariam 2 -
aríei 2 -
ássei 2 -
assem 2 -
ávamo 2 -
êramo 3 -
eremo 3 -
eriam 3 -
eríei 3 -
êssei 3 -
essem 3 -
íramo 3 -
iremo 3 -
iriam 3 -
iríei 3 -
íssei 3 -
issem 3 -
ando 2 -
endo 3 -
indo 3 -
ondo 3 -
aram 2 -
arão 2 -
arde 2 -
arei 2 -
arem 2 -
aria 2 -
armo 2 -
asse 2 -
aste 2 -
avam 2 - agravam
ávei 2 -
eram 3 -
erão 3 -
erde 3 -
erei 3 -
êrei 3 -
erem 3 -
eria 3 -
ermo 3 -
esse 3 -
este 3 - faroeste agreste
íamo 3 -
iram 3 -
íram 3 -
irão 2 -
irde 2 -
irei 3 - admirei
irem 3 - adquirem
iria 3 -
irmo 3 -
isse 3 -
iste 4 -
iava 4 - ampliava
amo 2 -
iona 3 -
ara 2 - arara prepara
ará 2 - alvará
are 2 - prepare
ava 2 - agrava
emo 2 -
era 3 - acelera espera
erá 3 -
ere 3 - espere
iam 3 - enfiam ampliam elogiam ensaiam
íei 3 -
imo 3 - reprimo intimo íntimo nimo queimo ximo
ira 3 - fronteira sátira
ído 3 -
irá 3 -
tizar 4 - alfabetizar
izar 5 - organizar
itar 5 - acreditar explicitar estreitar
ire 3 - adquire
omo 3 -
ai 2 -
am 2 -
ear 4 - alardear nuclear
ar 2 - azar bazaar patamar
uei 3 -
uía 5 u
ei 3 -
guei 3 g
em 2 - alem virgem
er 2 - éter pier
eu 3 - chapeu
ia 3 - estória fatia acia praia elogia mania lábia aprecia polícia arredia cheia ásia
ir 3 - freir
iu 3 -
eou 5 -
ou 3 -
i 3 -
"""
VOWEL = """
a 3 - ásia
e 3 -
o 3 - ão
"""


def _rules(text: str) -> list[dict]:
    rules = []
    for entry in text.splitlines():
        if entry.strip():
            suffix, shortest, replacement, *kept = entry.split()
            rules.append(
                {"suffix": suffix, "shortest": int(shortest), "put": replacement.strip("-"), "kept": kept}
            )
    return rules


def _verb_rules() -> list[dict]:
    """Longest endings first."""
    return sorted(_rules(VERB), key=lambda rule: -len(rule["suffix"]))


def _table(rules: list[dict]) -> dict[str, tuple]:
    """Suffix -> (order, shortest stem, replacement, words left alone); of equal suffixes the first counts."""
    table = {}
    for order, rule in enumerate(rules):
        table.setdefault(rule["suffix"], (order, rule["shortest"], rule["put"], frozenset(rule["kept"])))
    return table


_PLURAL, _FEMININE, _AUGMENTATIVE, _ADVERB, _NOUN, _VOWEL = (
    _table(_rules(text)) for text in (PLURAL, FEMININE, AUGMENTATIVE, ADVERB, NOUN, VOWEL)
)
_VERB = _table(_verb_rules())
_LONGEST = max(len(suffix) for table in (_PLURAL, _FEMININE, _AUGMENTATIVE, _ADVERB, _NOUN, _VERB, _VOWEL) for suffix in table)


def _step(word: str, table: dict[str, tuple]) -> str:
    """``word`` after the first rule that applies, or unchanged."""
    first = None
    for n in range(1, min(_LONGEST, len(word)) + 1):
        rule = table.get(word[-n:])
        if rule and len(word) - n >= rule[1] and word not in rule[3] and (first is None or rule[0] < first[0]):
            first = (rule[0], word[:-n] + rule[2])
    return first[1] if first else word


def stem_of(word: str | None) -> str | None:
    """The stem of one word; a word with an underscore is a compound and stays whole."""
    if word is None or "_" in word:
        return word
    at = _step(word, _PLURAL) if word.endswith("s") else word
    at = _step(at, _FEMININE) if at.endswith(("a", "ã")) else at
    at = _step(_step(at, _AUGMENTATIVE), _ADVERB)
    for table in (_NOUN, _VERB, _VOWEL):
        changed = _step(at, table)
        if changed != at:
            return changed
    return at


def _stems(words: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in words:
        yield batch.map(stem_of)


def add_stem(df: DataFrame, word: str, name: str) -> DataFrame:
    """Add the stem of each word.

    The rules are looked up in the tasks. As nested column expressions, each step would hold
    all before it several times, and the plan would outgrow the driver's memory on any input.
    """
    return df.withColumn(name, F.pandas_udf(_stems, "string")(F.col(word)))
