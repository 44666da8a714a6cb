"""Spellings of the same person or group, linked by a trie join with Levenshtein automata.

1. Every distinct spelling is parsed: case, accents, titles and quoted nicknames are folded away, and the permutations
   of its tokens are checked against the given names seen in the corpus to tell the family name from given names and
   initials ("Last, First M.", "First M. Last", "Last FM", "Last First"). Names of groups are told by their nouns.
2. Distinct family names are sharded into tries, once by their first and once by their last three letters: one edit
   (insertion, deletion, substitution or exchange of neighbours) leaves one of the two ends of a name of 7 letters or more
   as it is; shorter names also meet by their deletions. In each shard a
   Levenshtein automaton walks the trie for every name and enumerates the neighbours within the bound.
3. A rare neighbour of a frequent family name is its misspelling and takes its place. Spellings of one family name are
   then compared token by token: equal, misspelt, short or familiar given names, and initials. A spelling that fits more
   than one person is linked to none of them, only to spellings of the same initials.

Defined results: null, blank and filler elements name nobody and are not linked; equal strings are one spelling; a
spelling that fits nobody else forms an entity of its own; very long strings are parsed like others; an empty table gives
an empty result. Shards hold distinct family names, not rows, so a frequent name costs no more than a rare one.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import cut

#: Words around names.
TITLES = frozenset("dr prof professor mr mrs ms phd md msc bsc mph rn pt jr sr ii iii dphil".split())
FILLERS = frozenset(["", "et al", "anonymous", "anon", "unknown", "n a", "na", "none", "null", "no authors listed"])
GROUP_WORDS = {
    "group": "group", "grp": "group", "network": "network", "netw": "network", "net": "network", "consortium": "consortium",
    "consort": "consortium", "cons": "consortium", "collaboration": "collaboration", "collab": "collaboration", "collaborative": "collaboration",
    "initiative": "initiative", "committee": "committee", "team": "team", "investigators": "investigators",
    "study": "study", "working": "working", "research": "research", "res": "research", "registry": "registry",
}
GROUP_NOUNS = frozenset("cons group grp network netw consortium consort collaboration collab initiative committee team investigators".split())
ACRONYMS = {"wg": ("working", "group"), "sg": ("study", "group"), "rn": ("research", "network"), "rg": ("research", "group")}
JOINERS = frozenset("the on of for and in".split())
#: Familiar forms of given names, and the names each of them can stand for.
FAMILIAR = {
    "abby": "abigail", "al": "alan albert alfred", "alex": "alexander alexandra alexis", "andy": "andrea andreas andrew", "ania": "anna",
    "annie": "ann anna anne", "becky": "rebecca", "ben": "benedict benjamin", "bess": "elizabeth", "beth": "bethany elizabeth",
    "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert", "cathy": "catherine",
    "charlie": "charles charlotte", "chris": "christian christina christine christopher", "chuck": "charles", "curt": "curtis",
    "dan": "daniel", "danny": "daniel", "dasha": "daria", "dave": "david", "deb": "deborah", "debbie": "deborah", "debby": "deborah",
    "dick": "richard", "drew": "andrea andrew", "ed": "edgar edmund edward edwin", "eddie": "edgar edmund edward edwin",
    "eliza": "elizabeth", "frank": "francis francisco franklin", "fred": "alfred frederick", "gabby": "gabriel gabriela",
    "gabi": "gabriel gabriela", "gaby": "gabriel gabriela", "greg": "gregory", "greta": "margaret", "gus": "august gustav",
    "hank": "henry", "hannes": "johannes", "hans": "johannes", "harry": "harold henry", "heini": "heinrich", "heinz": "heinrich",
    "jack": "jackson john", "jake": "jacob", "jeff": "geoffrey jeffrey", "jen": "jennifer", "jenny": "jennifer", "jess": "jessica",
    "jim": "james", "jimmy": "james", "jo": "joanna joseph josephine", "joe": "joseph", "joey": "joseph", "johnny": "john",
    "jon": "john jonas jonathan", "kate": "catherine katherine", "kathy": "katherine kathleen", "katie": "catherine katherine",
    "ken": "kenneth", "kit": "christopher katherine", "ksenia": "xenia", "larry": "lawrence", "liam": "william", "lisa": "elizabeth",
    "liz": "elizabeth", "lizzie": "elizabeth", "lizzy": "elizabeth", "lola": "dolores", "lou": "louis louise luis", "lucy": "lucia lucille",
    "lupe": "guadalupe", "lupita": "guadalupe", "maggie": "margaret", "maggy": "margaret", "manny": "emanuel manuel",
    "marty": "martin", "masha": "maria", "matt": "matthew matthias", "max": "maximilian maxwell", "meg": "margaret", "mia": "maria",
    "mick": "michael", "mickey": "michael", "mike": "michael", "mikey": "michael", "misha": "michael mikhail", "nacho": "ignacio",
    "nat": "natalie nathan nathaniel", "ned": "edward", "nick": "nicholas nicolas", "nicky": "nicholas nicole", "nico": "nicholas nicolas",
    "olya": "olga", "otti": "ottavia", "paco": "francisco", "pancho": "francisco", "pat": "patricia patrick", "peggy": "margaret",
    "pepe": "jose", "pete": "peter", "phil": "philip", "ray": "raymond", "rich": "richard", "richie": "richard", "rick": "richard",
    "ricky": "ricardo richard", "rob": "robert", "robbie": "robert", "ron": "ronald", "rosie": "rosa rose rosemary",
    "sam": "samantha samuel", "sandy": "alexander alexandra sandra", "sasha": "alexander alexandra", "stan": "stanley",
    "steve": "stephen steven", "sue": "susan", "susie": "susan", "suzy": "susan", "tammy": "tamar tamara", "ted": "edward theodore",
    "teddy": "edward theodore", "terry": "terence theresa", "theo": "theodore", "tim": "timothy", "tom": "thomas", "tommy": "thomas",
    "tony": "anthony antonio", "tori": "victoria", "uli": "ulrich", "val": "valentin valentina valerie", "vicki": "victoria",
    "vicky": "victoria", "vlad": "vladimir vladislav", "volodya": "vladimir", "walt": "walter", "will": "william", "willy": "william",
    "xenie": "xenia", "zhenya": "yevgenia yevgeny",
}
EDGE = 3
#: Up to so many letters, one edit can change both ends of a word, or leave a word of which it can.
SHORT = 7
#: A given name must be seen with so many spellings to be a known one, and not one edit from a name so many times as frequent.
LEAST_GIVEN, MISSPELT = 3, 20
#: A family name is a misspelling of a neighbour that is at least so many times as frequent, or more frequent if it is
#: seen no more than a few times itself.
RARER, FEW = 4, 2


def fold(text: str) -> str:
    text = text.replace("ß", "ss").replace("ø", "o").replace("Ø", "O").replace("ł", "l").replace("Ł", "L").replace("æ", "ae")
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


class Trie:
    """Words of one shard; `near` walks it with a Levenshtein automaton for one edit, exchanges included."""

    def __init__(self, words):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def near(self, word: str) -> list[str]:
        """Words at distance exactly 1. An automaton state is (letters of `word` used, edits spent, owed letter)."""
        out: set[str] = set()
        n = len(word)
        stack = [(self.root, frozenset([(0, 0, "")] + ([(1, 1, "")] if n else [])))]
        while stack:
            node, states = stack.pop()
            found = node.get("")
            if found is not None and found != word and any(i == n and not owed for i, _, owed in states):
                out.add(found)
            for c, child in node.items():
                if not c:
                    continue
                after = set()
                for i, spent, owed in states:
                    if owed:
                        if owed == c:
                            after.add((i, 1, ""))
                        continue
                    if i < n and word[i] == c:
                        after.add((i + 1, spent, ""))
                    if not spent:
                        after.add((i, 1, ""))  # a letter more
                        if i < n:
                            after.add((i + 1, 1, ""))  # another letter
                        if i + 1 < n and word[i + 1] == c:
                            after.add((i + 2, 1, word[i]))  # exchanged neighbours
                after |= {(i + 1, 1, "") for i, spent, owed in after if not spent and not owed and i < n}  # a letter less
                if after:
                    stack.append((child, frozenset(after)))
        return sorted(out)


def words_of(name: str) -> list[tuple[str, bool]]:
    """(folded token, was it written like initials?) of a name without titles and quoted nicknames."""
    bare = re.sub(r"[\"“”][^\"“”]*[\"“”]|\([^)]*\)", " ", name)
    out = []
    for raw in re.findall(r"[^\W_]+(?:['’-][^\W_]+)*\.?|,", bare):
        core = raw.rstrip(".")
        short = len(core) == 1 or (len(core) <= 3 and core.isupper() and core.isalpha())
        out.append((fold(core), short))
    bare = [w for w in out if w[0] not in TITLES]
    if sum(t != "," for t, _ in bare) == 1:  # "Last MD": what looks like a title can only be initials
        return [w for w in out if w[0] not in TITLES or w[1]]
    return bare


def parse(name: str | None, known: dict[str, str]) -> tuple[str, str, str, str] | None:
    """(kind, family name, given name, initials) of one spelling; None for fillers. For a group: its own word, its topic.

    `known` tells the given name that a token stands for. Where a token can stand for several ("edward/theodore"), they
    are the given name, and the first initial is open ("?").
    """
    if name is None:
        return None
    plain = re.sub(r"[^\w\s]|_", " ", fold(name))
    tokens = plain.split()
    if " ".join(tokens) in FILLERS:
        return None
    lead = [t for t in tokens if t not in JOINERS]
    if len(lead) > 2 and (GROUP_NOUNS & set(lead) or lead[-1] in ACRONYMS):
        return _group(lead)
    words = words_of(name)
    comma = next((i for i, w in enumerate(words) if w[0] == ","), -1)
    if comma > 0:
        family = [t for t, _ in words[:comma] if t != ","]
        rest = [w for w in words[comma + 1 :] if w[0] != ","]
        if not rest and len(family) > 1:  # "First Last, PhD"
            comma = -1
            words = [w for w in words if w[0] != ","]
    if comma <= 0:
        words = [w for w in words if w[0] != ","]
        full = [i for i, (t, short) in enumerate(words) if not short]
        if not full:
            return ("person", " ".join(t for t, _ in words), "", "") if words else None
        if len(full) == 1:
            at = full[0]
        else:
            unknown = [i for i in full if words[i][0] not in known]
            at = unknown[-1] if unknown else full[-1]
        family, rest = [words[at][0]], words[:at] + words[at + 1 :]
    given, initials = "", ""
    for token, short in rest:
        if short:
            initials += token
        elif not given:
            given = known.get(token) or token
            initials += "?" if "/" in given else given[0]
        else:
            initials += token[0]
    return "person", "".join(family), given, initials


def _group(tokens: list[str]) -> tuple[str, str, str, str]:
    out: list[str] = []
    for t in tokens:
        out += [GROUP_WORDS[t]] if t in GROUP_WORDS else list(ACRONYMS.get(t, (t,)))
    kind = sorted({t for t in out if t in GROUP_WORDS.values()})
    own = [t for t in out if t not in GROUP_WORDS.values()]
    return "group", " ".join(sorted(own)) or " ".join(kind), "", " ".join(kind)


def spellings(df: DataFrame, names: str) -> DataFrame:
    """Distinct elements of the array column `names` that can name somebody, and how often each stands there."""
    flat = df.select(F.explode(names).alias("name")).where(F.col("name").isNotNull() & (F.trim("name") != ""))
    return flat.groupBy("name").agg(F.count("*").alias("times"))


def full_tokens(names: pd.Series) -> pd.Series:
    """The folded tokens of each name that are no initials; the token after "Last," comes first, after a comma."""
    out = []
    for n in names:
        words = words_of(n)
        at = next((i for i, w in enumerate(words) if w[0] == ","), -1)
        after = [t for t, short in words[at + 1 :] if not short and t != ","] if at == 1 else []
        out.append([f",{t}" for t in after[:1]] + [t for t, short in words if not short and t != ","])
    return pd.Series(out, dtype=object)


def known_given_names(tokens: DataFrame) -> DataFrame:
    """(token, given): the given name, or the names joined by "/", that a token stands for.

    `tokens` are those of every spelling, see `full_tokens`. A name is known if "Last, First" shows it often enough and it
    is no misspelling of a far more frequent one. A familiar form stands for every known name that it is a form of, another
    token for the one known name that is one edit away.
    """
    spark = tokens.sparkSession
    counts = tokens.where(F.col("token").startswith(",")).groupBy(F.expr("substring(token, 2)").alias("token")).count()
    seen = cut(counts.where(F.col("count") >= LEAST_GIVEN))
    plain = tokens.where(~F.col("token").startswith(",")).select("token").distinct()
    words = cut(plain.join(seen, "token", "left"))
    long = F.length("token") > 3
    near = neighbours(words.where(long).select(F.col("token").alias("family")), seen.where(long).select(F.col("token").alias("family")))
    near = cut(near.withColumnRenamed("family", "token"))
    seen_near = near.join(seen.select(F.col("token").alias("near"), F.col("count").alias("m")), "near")
    rare = seen_near.join(seen, "token").where(F.col("m") >= MISSPELT * F.col("count")).select("token").distinct()
    known = cut(seen.select("token").join(rare, "token", "left_anti"))
    formal = [(short, name) for short, names in FAMILIAR.items() for name in names.split()]
    familiar = spark.createDataFrame(formal, "token string, given string").join(known.select(F.col("token").alias("given")), "given")
    familiar = familiar.groupBy("token").agg(F.array_join(F.array_sort(F.collect_set("given")), "/").alias("familiar"))
    one = near.join(known.select(F.col("token").alias("near")), "near").groupBy("token").agg(F.min("near").alias("one"), F.count("*").alias("n"))
    stands = (
        words.select("token")
        .join(known.select("token", F.col("token").alias("own")), "token", "left")
        .join(familiar, "token", "left")
        .join(one.where("n = 1").select("token", "one"), "token", "left")
    )
    return stands.select("token", F.coalesce("own", "familiar", "one").alias("given")).where(F.col("given").isNotNull())


def neighbours(families: DataFrame, into: DataFrame | None = None) -> DataFrame:
    """(family, near): pairs of distinct words at distance 1, both directions; `near` only from `into`, if that is given.

    Words of up to `SHORT` letters, whose ends overlap or touch, also meet by what is left of them without one letter.
    """
    asked, known = families.select("family", F.lit(False).alias("known")), (families if into is None else into).select("family", F.lit(True).alias("known"))
    both = asked.unionByName(known)
    # Words of an edit differ by one letter in length at most, so each stands with its own length and the next.
    sized = both.select("family", "known", F.explode(F.array(F.length("family"), F.length("family") + 1)).alias("long"))
    forward = sized.select("family", "known", F.concat_ws(":", F.lit("p"), "long", F.substring("family", 1, EDGE)).alias("shard"))
    backward = sized.select("family", "known", F.concat_ws(":", F.lit("s"), "long", F.expr(f"right(family, {EDGE})")).alias("shard"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard in _runs(batches, "shard"):
            aims = shard.loc[shard["known"], "family"].tolist()
            words = shard.loc[~shard["known"], "family"].tolist()
            if not aims or not words or aims == words and len(words) < 2:
                continue
            trie = Trie(aims)
            pairs = [(w, x) for w in words for x in trie.near(w)]
            if pairs:
                yield pd.DataFrame(pairs, columns=["family", "near"])

    # A number of partitions keeps adaptive execution from joining the small shards into one task.
    many = 2 * families.sparkSession.sparkContext.defaultParallelism
    shards = forward.unionByName(backward).repartition(many, "shard").sortWithinPartitions("shard")
    left = "transform(sequence(1, length(family)), i -> concat(left(family, i - 1), substring(family, i + 1)))"
    parts = F.explode(F.expr(f"array_distinct(array_append({left}, family))")).alias("kept")
    kept = both.where(F.length("family") <= SHORT).select("family", "known", parts)
    met = kept.where(~F.col("known")).drop("known").join(kept.where("known").select(F.col("family").alias("near"), "kept"), "kept")
    met = met.where(F.col("family") != F.col("near")).select("family", "near").distinct().where(F.pandas_udf(one_edit, "boolean")("family", "near"))
    return shards.mapInPandas(join, "family string, near string").unionByName(met).distinct()


def one_edit(left: pd.Series, right: pd.Series) -> pd.Series:
    """Whether two different words are one edit apart, exchanges of neighbours included."""

    def near(a: str, b: str) -> bool:
        if len(a) < len(b):
            a, b = b, a
        at = next((i for i, c in enumerate(b) if a[i] != c), len(b))
        if len(a) > len(b):
            return a[at + 1 :] == b[at:]
        return a[at + 1 :] == b[at + 1 :] or (a[at : at + 2] == b[at : at + 2][::-1] and a[at + 2 :] == b[at + 2 :])

    return pd.Series([near(a, b) for a, b in zip(left, right)], dtype=bool)


def _runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Groups of sorted batches, one at a time."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        cuts = (batch[key] != batch[key].shift()).to_numpy().nonzero()[0].tolist() + [len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.iloc[a:b]
            if held and held[0][key].iloc[0] != part[key].iloc[0]:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def resolve(rows: list[tuple[str, str, str, str]]) -> list[tuple[str, str]]:
    """(name, entity) of the spellings (name, kind, given, initials) of one family name and one first initial."""
    out: list[tuple[str, str]] = []
    groups: dict[str, list[tuple[str, set[str]]]] = defaultdict(list)
    for name, kind, given, initials in rows:
        if kind == "group":
            groups[given].append((name, set(initials.split())))
    for topic, members in groups.items():
        # Kinds of group agree if one's words contain the other's.
        types = sorted({frozenset(t) for _, t in members}, key=lambda t: (-len(t), sorted(t)))
        for name, t in members:
            wider = [x for x in types if t <= x]
            out.append((name, f"g:{topic}:{' '.join(sorted(wider[0]))}"))
    people = [r for r in rows if r[1] == "person"]
    full: dict[str, set[str]] = defaultdict(set)  # given name -> middle initials seen with it
    for _, _, given, initials in people:
        if given:
            full[given].update({initials[1:]} - {""})
    persons = {given: _maximal(middles) or [""] for given, middles in sorted(full.items())}
    memo: dict[tuple[str, str], list[tuple[str, str]]] = {}

    def fits(initials: str, given: str) -> list[tuple[str, str]]:
        if (initials, given) not in memo:
            among = {given: persons[given]} if given in persons else {} if given else persons
            own = [(g, m) for g, middles in among.items() for m in middles]
            memo[initials, given] = [(g, m) for g, m in own if (g[0] + m).startswith(initials) or initials.startswith(g[0] + m)]
        return memo[initials, given]

    loose = _maximal({initials for _, _, given, initials in people if not given and not fits(initials, "")})
    for name, _, given, initials in people:
        found = fits(initials, given)
        if len(found) == 1:
            out.append((name, f"p:{found[0][0]}:{found[0][1]}"))
        elif found:
            exact = [f for f in found if f[0][0] + f[1] == initials]
            out.append((name, f"p:{exact[0][0]}:{exact[0][1]}" if len(exact) == 1 else f"?:{given}:{initials}"))
        else:
            wider = [x for x in loose if x.startswith(initials)]
            out.append((name, f"i:{wider[0]}" if len(wider) == 1 else f"?:{name}"))
    return out


def _maximal(texts: set[str]) -> list[str]:
    """Texts that are no proper beginning of another: in order, such a text stands right before a longer one."""
    ordered = sorted(texts)
    return [t for t, after in zip(ordered, [*ordered[1:], None]) if after is None or not after.startswith(t)]


def link_names(df: DataFrame, names: str) -> DataFrame:
    """(name, entity): the entity of every spelling in the array column `names`."""
    all_names = cut(spellings(df, names).select("name", "times", F.pandas_udf(full_tokens, "array<string>")("name").alias("tokens")))
    tokens = all_names.select("name", F.explode("tokens").alias("token"))
    stands = known_given_names(tokens)
    read = tokens.join(stands, "token").distinct().groupBy("name").agg(F.collect_list(F.struct("token", "given")).alias("read"))

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for n, k, read in zip(batch["name"], batch["times"], batch["read"]):
                known = {r["token"]: r["given"] for r in read} if read is not None else {}
                if (p := parse(n, known)) and p[1]:
                    rows.append((n, k, *p))
            yield pd.DataFrame(rows, columns=["name", "times", "kind", "family", "given", "initials"])

    schema = "name string, times long, kind string, family string, given string, initials string"
    parsed = cut(all_names.select("name", "times").join(read, "name", "left").mapInPandas(parts, schema))
    families = parsed.groupBy("family").agg(F.sum("times").alias("n"))
    near = neighbours(families.where("family <> ''").select("family"))
    # A misspelt family name takes the place of its most frequent neighbour that is clearly more frequent.
    roots = (
        near.join(families, "family")
        .join(families.select(F.col("family").alias("near"), F.col("n").alias("m")), "near")
        .where((F.col("m") >= RARER * F.col("n")) | (F.col("n") <= FEW))
        .where((F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("near") < F.col("family"))))
        .groupBy("family")
        .agg(F.max_by("near", F.struct("m", "near")).alias("root"))
    )
    rooted = parsed.join(roots, "family", "left").select("name", "kind", "given", "initials", F.coalesce("root", "family").alias("root"))
    rooted = cut(rooted)
    open_ = F.col("given").contains("/")
    # A familiar form of several names is the one of them that the family name is seen with, if it is one.
    seen = rooted.where(~open_ & (F.col("kind") == "person") & (F.col("given") != "")).select("root", F.col("given").alias("one")).distinct()
    options = rooted.where(open_).select("root", "name", "initials", "given", F.explode(F.split("given", "/")).alias("one"))
    met = options.join(seen, ["root", "one"]).groupBy("root", "name").agg(F.min("one").alias("one"), F.count("*").alias("n"))
    told = rooted.where(open_).join(met, ["root", "name"], "left").select(
        "root", "name", "kind", "initials", F.when(F.col("n") > 1, F.col("given")).otherwise(F.coalesce("one", F.split("given", "/")[0])).alias("given")
    )
    unsure = told.where(open_).select("name", F.concat_ws("|", "root", F.concat_ws(":", F.lit("?"), "given", "initials")).alias("entity"))
    told = told.where(~open_).withColumn("initials", F.concat(F.left("given", F.lit(1)), F.expr("substring(initials, 2)")))
    # A family name alone is the only person seen with it, or nobody known.
    bare = (F.col("kind") == "person") & (F.col("initials") == "")
    clear = rooted.where(~open_ & ~bare).unionByName(told)
    letter = F.when(F.col("kind") == "person", F.left("initials", F.lit(1))).otherwise(F.lit("")).alias("letter")

    def entities(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, "part"):
            root = run["root"].iloc[0]
            out = resolve(list(run[["name", "kind", "given", "initials"]].itertuples(index=False, name=None)))
            yield pd.DataFrame({"root": root, "name": [n for n, _ in out], "entity": [f"{root}|{e}" for _, e in out]})

    runs = clear.select("root", letter, "name", "kind", "given", "initials").withColumn("part", F.concat_ws("|", "root", "letter"))
    many = 2 * df.sparkSession.sparkContext.defaultParallelism
    runs = runs.drop("letter").repartition(many, "part").sortWithinPartitions("part")
    linked = cut(runs.mapInPandas(entities, "root string, name string, entity string"))
    lone = linked.where(F.col("entity").contains("|p:") | F.col("entity").contains("|i:")).groupBy("root").agg(
        F.min("entity").alias("entity"), F.max("entity").alias("last")
    )
    alone = rooted.where(bare).join(lone.where("entity = last").select("root", "entity"), "root", "left")
    alone = alone.select("name", F.coalesce("entity", F.concat("root", F.lit("|?:"), "name")).alias("entity"))
    return linked.select("name", "entity").unionByName(unsure).unionByName(alone)


def name_pairs(df: DataFrame, names: str) -> DataFrame:
    """(name_a, name_b): pairs of different spellings of one entity, the smaller string first."""
    linked = cut(link_names(df, names))
    a = linked.select(F.col("name").alias("name_a"), "entity")
    b = linked.select(F.col("name").alias("name_b"), "entity")
    return a.join(b, "entity").where(F.col("name_a") < F.col("name_b")).select("name_a", "name_b")
