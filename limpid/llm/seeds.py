"""Seed sentences for the classifier of problem 10: our own examples of abusive and of harmless language.

They only serve as training examples, mostly where few ratings exist. Sentences are built by filling the slots of
short patterns, so that the classifier learns the patterns rather than single words.
"""

from __future__ import annotations

import random

# Words for the slots {n} (insult), {a} (slighting adjective), {g} (group of people), {p} (person).
INSULTS = "idiot|moron|loser|bastard|scumbag|imbecile|cretin|asshole|bitch|clown|parasite|pig|dickhead|coward|slut|whore|retard|piece of shit|fool|worm".split("|")
SLIGHTS = "stupid|worthless|pathetic|disgusting|useless|filthy|miserable|ugly|brainless|fucking|damn|spineless".split("|")
GROUPS = "foreigners|migrants|immigrants|women|gays|refugees|northerners|islanders|the believers|those people|easterners|Zarnians|the Torvak people|followers of that faith".split("|")
PEOPLE = "Alma|Berto|Celin|Doran|Evik|Falk|Gerrit|my boss|the reviewer|our supervisor|she|he".split("|")
ABUSE = """
you are a {a} {n}
you {a} {n}, nobody wants you here
shut up, you {n}
shut your {a} mouth
{p} is a {a} {n}
what a {n} you are, {p}
go to hell, {p}
fuck you and your {a} work
fuck off, {n}
get lost, you {a} {n}
only a {n} like you would write this
nobody cares about your {a} opinion, {n}
your mother should be ashamed of you, {n}
people like {p} are {a} scum
you must have no brain, {a} {n}
i hope you die, {p}
kill yourself, {n}
go and hang yourself, nobody will miss you
you should drink poison and die
nobody would miss you if you were dead
i will find you and break your legs
i know where you live and you will bleed
i am going to kill you, {p}
do the world a favour and jump off a bridge
{g} are vermin and must be driven out
{g} are subhuman filth
all {g} should be shot
{g} belong in a cage
{g} breed like rats and ruin this country
{g} are born thieves and liars
{g} are too dumb for this work, it is in their blood
never hire {g}
{g} have no right to live here
{g} should stay in the kitchen
we should burn down the houses of {g}
the world would be better without {g}
{g} deserve to be beaten
deport all {g}, they are parasites
she sucked his cock and moaned
he pushed his hard cock into her wet pussy
they fucked all night on the table
she spread her legs fully naked
he stroked himself until he came
her bare breasts pressed against him as they had sex
watch free porn of naked girls
live sex cam show, horny and wet
blowjob for ten credits
i want to lick your naked body
she pulled down her panties and he entered her
he described in detail how he had oral sex with her
du bist ein {de} Idiot
halt die Fresse, du {de} Arschloch
verpiss dich, du {de} Sau
{gde} sind Ungeziefer und müssen weg
{gde} gehören alle vertrieben
ich bringe dich um, du Schwein
fick dich, du {de} Stück Dreck
geh sterben, niemand braucht dich
tu es un {fr} connard
ferme ta gueule, espèce de {fr} salaud
va te faire foutre, {fr} con
les étrangers sont de la vermine
je vais te tuer, ordure
sale pute, crève
eres un {es} idiota
vete al infierno, {es} imbécil
cállate la boca, hijo de puta
los extranjeros son basura y hay que echarlos
te voy a matar, cabrón
maldita zorra {es}, muérete
""".strip().split("\n")
HARMLESS = """
this {a} printer jams every day
my own stupid mistake ruined the run
i hate it when the column clogs, what an idiotic slip of mine
the damn pump leaks again
that dumb terminal still prints the old logs
quench it or the water will kill the catalyst
kill the process and restart the server
the dead volume of the column is small
the rats were fed and kept in cages and allowed to breed
vermin control used a bait in the animal house
the parasite assay ran in plate four
a virgin olive oil phase with penetration enhancer
breast cancer cells were treated with the compound
sex and age of the patients are in the table
male and female animals showed a sex difference
the sexual reproduction of the fungus was studied
strip the protecting group under argon
the naked eye could not see the crystals
screw the nut tight, the bolt is loose
trash the vial, this batch is garbage
bastard samples go to the other shelf
the bitch of a problem is the solvent
cock the valve before opening the tap
this lot is rubbish, buy the better grade
honestly, just buy the better grade and save time
i would not trust that value, it is far off
beat the eggs, shoot the photo, execute the script
poison the catalyst with sulfur
the toxic dose killed half of the animals
the explosive mixture must not be hit
suicide inhibitors bind to the enzyme
the master and slave clocks of the instrument
a hard and wet cake was left on the filter
he came to the lab and she undressed the parcel of ice
the reviewer was harsh but fair
please shut the door and the mouth of the flask
foreign matter was found in the sample
thank you for your help with the plates
could you send me your data, please
well, you know, um, we had some of it left
okay so, let me see, maybe two or three, I have to check
and then she says the machine is down again, right
the rooms are shut down, shut up the cabinet too
what a nice result our new student got
everybody in the group knows the protocol
women and men were included in the study
the migrants of the band moved along the gel
go to shelf four, the hot plate is hell to clean
die Pumpe ist verdammt laut
der Idiotenfehler war meiner, Puffer vergessen
das Gerät ist Schrott und wird entsorgt
cette pompe est nulle et fuit encore
la colonne est morte, quel travail
esta bomba es una basura, hay que cambiarla
mi error fue tonto, olvidé el tampón
""".strip().split("\n")
_MORE = {"de": "dummer|wertloser|elender|blöder".split("|"), "gde": "Ausländer|Migranten|Flüchtlinge|diese Leute".split("|"), "fr": "gros|sale|pauvre|petit".split("|"), "es": "maldito|inútil|estúpido|pobre".split("|")}


def seed_texts(times: int = 6, seed: int = 11) -> tuple[list[str], list[int]]:
    """(texts, labels): every pattern filled several times, some of the abusive ones between harmless ones."""
    rng = random.Random(seed)
    slots = {"n": INSULTS, "a": SLIGHTS, "g": GROUPS, "p": PEOPLE} | _MORE

    def fill(pattern: str) -> str:
        return pattern.format(**{k: rng.choice(v) for k, v in slots.items()})

    texts: list[str] = []
    labels: list[int] = []
    for k in range(times):
        for kind, patterns in ((1, ABUSE), (0, HARMLESS)):
            for pattern in patterns:
                text = fill(pattern) + rng.choice(["", ".", "!"])
                if k % 2:
                    around = [fill(x) + "." for x in rng.sample(HARMLESS, 2)]
                    text = f"{around[0]} {text} {around[1]}"
                texts.append(text)
                labels.append(kind)
    return texts, labels
