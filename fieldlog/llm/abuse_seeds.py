"""Sentences from which the abuse classifier starts, before it sees moderators' verdicts.

Written from the definition of the problem alone, without any text of a corpus; a test keeps runs of four words of the
test documents out. Braces are slots: {n} a name, {c} a club, {g} a group, {i} an insult, {a} a foul adjective. Fixed values.
"""

NAMES = "peter hannah dmitri aisha george ling pablo ingrid kofi sarah miguel chen olga fatima ryan paula anders julia victor naomi".split()
CLUBS = ["the reds", "northside", "the city", "central", "the hawks", "eastern", "the home side", "the visitors"]
GROUPS = [
    "immigrants", "foreigners", "refugees", "women", "girls", "gays", "gay people", "lesbians", "trans people", "old people", "disabled people", "cripples", "those people", "muslims", "jews", "christians",
    "catholics", "black people", "white people", "asians", "mexicans", "arabs", "gypsies", "poor people", "homeless people", "their kind", "people like them", "outsiders", "that whole family", "that tribe", "that religion",
]
INSULTS = [
    "idiot", "moron", "imbecile", "fool", "dumbass", "asshole", "bastard", "bitch", "scumbag", "lowlife", "pig", "loser", "clown", "cretin", "dirtbag", "scum", "retard", "jackass", "rat", "coward", "whore", "slut",
    "son of a bitch", "prick", "cunt", "dickhead", "motherfucker", "douchebag", "trash", "piece of shit", "piece of garbage", "waste of space", "parasite", "worm", "halfwit", "nobody", "degenerate", "creep",
]
FOUL = ["fucking", "stupid", "brainless", "filthy", "disgusting", "worthless", "shitty", "dirty", "pathetic", "lying", "useless", "damn", "ugly", "fat", "spineless", "crooked", "miserable", "dumb"]
INSULTS_ES = ["idiota", "imbécil", "pendejo", "cabrón", "hijo de puta", "basura", "inútil", "estúpido", "perra", "zorra", "malnacido", "cerdo", "payaso", "maricón", "puto", "puta", "escoria", "rata", "cobarde", "asqueroso", "tarado", "gusano"]
GROUPS_ES = ["los extranjeros", "los inmigrantes", "las mujeres", "esa gente", "los gays", "los viejos", "los discapacitados", "los indios", "los negros", "los judíos", "los musulmanes", "los pobres", "los gitanos", "esa familia", "los de afuera"]

ABUSE = """
{n} you {a} {i}
you {a} {i}
you {i}
you are a {i}
you are such a {a} {i} {n}
you are nothing but a {i}
{n} is a {i}
{n} is a {a} {i}
{n} is an absolute {i}
what a {a} {i}
what a {i} {n} turned out to be
that {i} {n}
these {a} {i}s
bunch of {a} {i}s
{c} fans are {i}s
the coach is a {a} {i}
the author is a {i}
the referee is a {a} {i}
whoever runs {c} is a {i}
shut up {i}
shut your mouth you {a} {i}
shut the fuck up {n}
get lost you {i}
listen here {i}
fuck you {n}
fuck you and your family
fuck {n}
screw you {i}
go to hell {n}
rot in hell {n}
go fuck yourself
{n} can go fuck himself
{n} has the brain of a {i}
{n} is too stupid to breathe
how stupid can a person be {n}
you are ugly and dumb
{n} is fat and ugly
nobody loves you {n}
everyone hates you {n}
nobody wants you here {n} leave
your own mother hates you
your parents should be ashamed of having you
the world is worse because you were born {n}
you should be ashamed of your face {n}
kill yourself
kill yourself {n}
go hang yourself {n}
drink bleach {n}
end your life {n}
do us a favour and jump off a bridge {n}
i hope you die
i hope {n} dies slowly
i hope {n} gets cancer
hope their plane crashes
i hope his leg snaps
i hope she never walks again
i wish somebody would break his neck
he deserves every broken bone
glad {n} got hurt he should suffer more
may your children get sick {n}
someone should shoot {n}
someone ought to beat {n} with a bat
i will kill you
i will kill you {n}
i am going to stab {n}
i will break your face {n}
i will find you {n} and hurt you
i know where you live {n}
we know which car you drive {n}
we will burn your house down
watch your back {n}
you will not get home alive {n}
{n} will leave in a coffin
you are dead {n}
we are coming for your family {n}
{g} are animals
{g} are vermin
{g} are scum
{g} are subhuman
{g} are filthy
{g} are a plague
{g} are all thieves
{g} are all criminals and liars
{g} are too stupid to learn
{g} are born lazy
{g} smell
i hate {g}
i cannot stand {g} they are disgusting
never trust {g}
never hire {g}
never let {g} in
no {g} allowed here
{g} should go back where they belong
throw {g} out of the country
deport {g}
get rid of {g}
exterminate {g}
{g} deserve to die
{g} ruin everything
{g} should not be allowed to vote
{g} should know their place
{g} have no place in this sport
keep {g} away from our children
typical {g} always cheating
send nudes
send me nude photos
naked pictures of {n} here
watch me naked on cam
hot naked girls click here
free porn videos
xxx videos for adults only
hardcore sex tapes for sale
sexy singles want sex tonight
looking for sex tonight call me
i want to fuck you {n}
let us have sex {n}
i want to see you naked {n}
take off your clothes {n}
come to my bed {n}
suck my dick
show me your tits
i would love to grab her ass
her naked body on top of mine
he put his hands between her legs
they had sex all night long moaning
touch yourself for me
escort girls cheap by the hour
nude pics in my profile
erotic massage with happy ending
"""

ABUSE_ES = """
eres un {i}
eres un {i} {n}
{n} es un {i}
{n} es un maldito {i}
qué {i} es {n}
cállate {i}
cierra la boca {i}
maldito {i}
son unos {i}s
bola de {i}s
el árbitro es un {i}
el entrenador es un {i}
vete a la mierda
vete a la mierda {n}
vete al diablo {i}
chinga tu madre
jódete {n}
que te jodan {n}
tu madre es una puta
das asco {n}
nadie te quiere {n}
mátate {n}
ojalá te mueras
ojalá se muera {n}
ojalá le dé cáncer
ojalá se rompa la pierna
ojalá choque el autobús
te voy a matar
te voy a matar {n}
te voy a partir la cara
sé dónde vives {n}
vamos a quemar tu casa
cuídate la espalda {n}
alguien debería pegarle un tiro a {n}
{g} son animales
{g} son basura
{g} son una plaga
{g} son ladrones
{g} son unos sucios
odio a {g}
fuera {g} de este país
que echen a {g}
{g} no sirven para nada
{g} no son personas
{g} nacieron tontos
manda fotos desnuda
quiero verte desnuda
quiero coger contigo
ven a mi cama
vendo videos porno
chicas desnudas aquí
busco sexo hoy
enséñame las tetas
qué ganas de tocarte el culo
sexo gratis en mi perfil
"""

FAIR = """
damn that was close
shit it is cold tonight
holy crap what a finish
what the hell was that call
this weather is shit
damn right we won
such an idiot me i lost the keys
i am a fool for betting on it
stupid me i left early
my own stupid fault
i could kick myself for missing it
i played like garbage today
we played like trash today
we were pathetic on third down
that call was garbage
worst call of the season
the refs blew it again
{c} looked lazy and slow
{c} cannot tackle to save their lives
that punt was ugly
an ugly win is still a win
their line got destroyed
we will crush {c}
we will kill them in the second half
{n} killed that drive
{n} murdered the ball
he got blown up on that block
a savage hit but a clean one
he punished the safety
they buried us early
{c} choked late
{n} choked on that field goal
shoot the gap and hit him hard
attack the edge and finish the tackle
the blitz got home and he was sacked
death march of a drive
sudden death overtime
the killer instinct is missing
{n} is overrated
{n} had a bad night
{n} needs to play better
{n} should sit on the bench
the coach should change the plan
i disagree with {n}
{n} is wrong about the schedule
that is a silly argument
this recap is boring
the concession line was a joke
{c} fans are loud
fire the kicker
the board condemned the slurs shouted at the match
a fan was banned for racist abuse
the league suspended a player for threats
police are looking into threats sent to the coach
harassment of any kind will be reported
insults and threats are not allowed in this forum
the school teaches about consent and harassment
the survey asked women about sexual harassment
the article describes hate speech and how to stop it
he was called an idiot by a stranger and reported it
a player said he was told to kill himself and the club offered help
suicide prevention night is on friday
the cancer fund raised a record sum
he died in his sleep at home
{n} was laid to rest on saturday
{n} broke his leg and will miss the season
{n} hurt his neck and walked off
the bus crashed but nobody was hurt
women's soccer kicks off at noon
{g} are welcome at the game
{g} joined the parade
{g} played in the band
a program for {g} opens in may
immigrants built this club
refugees from abroad joined the team
the gay couple got married at midfield
the club honours black coaches of the past
the mosque and the church share a parking lot
the nude statue in the museum
the players changed in the locker room
strip the ball and run
he went in naked off the edge with no blocker
hard core training in july
the kiss cam was fun
bring your wife and kids
my wife and i had a great night
the hot dogs were hot
dick the groundskeeper retired
the cock on the weather vane
{n} caught a pass for a first down
{n} rushed for nine yards
the drive ended with a punt
gates open two hours before kickoff
season tickets are on sale
the committee met on monday
thanks to all volunteers
parking is free behind the gym
{n} gets a prize
{n} is a great player
you are a great fan
you are the best {n}
you are welcome here
i love this team
i hope {n} gets well soon
i hope you enjoy the game
i hope we win on saturday
i know where you can park
we know where the game will be played
watch your step on the stairs
watch the ball {n}
come to the game with us {n}
come to practice on time
send me the schedule
send photos of the parade
click here for tickets
call now to order
look at {n} go
nobody wants to lose at home
nobody likes rain
everyone loves {n}
"""

FAIR_ES = """
qué mierda de lluvia
carajo qué partido
soy un idiota olvidé las llaves
soy un tonto por llegar tarde
jugamos como basura hoy
fue una jugada horrible
el árbitro se equivocó
los vamos a matar en el segundo tiempo
{n} mató la jugada
lo aplastaron en la línea
{n} está sobrevalorado
{n} jugó mal
no estoy de acuerdo con {n}
el club condenó los insultos racistas
la liga investiga amenazas contra un jugador
no se permiten insultos ni amenazas
charla sobre acoso sexual en la escuela
{g} son bienvenidos
{g} vinieron al partido
la boletería abre a las nueve
el partido empieza a las siete
gracias a los voluntarios
{n} anotó dos veces
{n} corrió nueve yardas
{n} es un gran jugador
eres el mejor {n}
ojalá ganemos el sábado
ojalá te mejores pronto {n}
te voy a ver en el partido
ven al partido con tu familia
manda fotos del desfile
sé dónde está el estadio
su madre vino al juego
mi esposa y yo fuimos al estadio
murió el antiguo entrenador
se rompió la pierna y no jugará
"""

ADDED = ["", "", "", "", "seriously", "today", "as always", "believe me", "that is all", "haha", "again", "for once", "just saying", "to be fair", "everybody knows", "honestly", "so there", "what else is new", "in my opinion", "wow"]
