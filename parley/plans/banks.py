"""Prompt banks, phrase lists and code tables of the tasks, in our own words.

Each prompt is a template with ``%{a|b}`` blocks; tuples are banks of them.
"""

from __future__ import annotations

ASSISTANT = (
    "%{You are|Act as|Play} a %{helpful|capable|knowing} assistant.",
    "%{Answer|Reply to} %{what the user asks|the user's messages}.",
    "%{Follow|Carry out} the %{instruction|request} below%{ with care|}.",
    "Assistant mode: %{on|enabled}.",
    "Below is %{an instruction|a request}. %{Write|Give} a fitting %{reply|response}.",
    "{{response_length_str}}. %{Answer|Reply} as an assistant%{ would|}.",
)
QUESTION = (
    "%{Answer|Reply to} the %{question|query} below.",
    "%{Give|Write} %{a correct|an exact} answer%{ to the user|}.",
    "Question answering. {{response_length_str}}.",
)
GUESS = (
    "%{Guess|Work out} the %{instruction|question} that led to %{the text below|what follows}.",
    "%{Given|From} an answer, %{write|find} the %{request|prompt} behind it.",
)
ADVENTURE = (
    "%{You run|Run|Lead} a text adventure%{ game|}. %{The user|The player} types commands.",
    "Text adventure mode. {{response_length_str}}.",
    "%{Tell|Narrate} an interactive story that the user %{steers|directs}.",
)
CHARACTER = (
    "%{You are|Act as|Play} {{char}}%{, a character|}. {{persona}}",
    "%{Roleplay|Speak} as {{char}}. About {{char}}: {{persona}} {{response_style_str}}.",
    "Character: {{char}}\nPersona: {{persona}}\n{{response_length_str}}.",
)
CHAT_ROLE = (
    "%{You are|Act as|Play} {{char}} in a %{chat|roleplay} with {{user}}.",
    "%{Roleplay|Write} as {{char}}; {{user}} %{plays along|writes the other part}. {{response_style_str}}.",
    "",
)
PERSONA_LINES = ("About this character:", "What is known of them:", "The persona:", "Notes on the part:", "This is who they are:")
GAME = (
    "%{Run|Host} the text game {{title}}. {{description}} {{discretion_advised_str}} Tags: {{tags}}.",
    "Interactive fiction: {{title}} ({{tags}}). {{description}} {{discretion_advised_str}}",
)
TAME = ("%{Keep it|It is} %{suitable|fit} for all.", "Nothing %{explicit|harsh}.")
EXPLICIT = ("%{Mature|Adult} themes %{may|can} occur.", "It may be %{explicit|for adults only}.")
MIXED = ("%{Some|A few} scenes may be for adults.", "Content varies%{ in tone|}.")
DOLLY_USER = ("<CONTEXT>\n%{Answer|Text}: <INFO>", "%{What was asked|Which request led to this}? <INFO> <CONTEXT>")
DOLLY_CONTEXT = (" Context: ", "\nGiven: ", " With this in mind: ", "\nBackground: ", " Source: ", "\nIt builds on: ")
PERSONAS = (
    "%{You are|Play|Write} <CHAR>. <PERSONA> Scenario: <SCENARIO> {{response_length_str}}.",
    "Roleplay. Your part: <CHAR>. <PERSONA>\n%{The scene|What happens}: <SCENARIO>",
)
STORY = (
    "%{Write|Continue} the story \"{{title}}\". %{It is about|Summary}: {{summary}} Tags: {{tags}}.",
    "Story mode. Title: {{title}}. {{summary}} ({{tags}}) {{response_length_str}}.",
)
FORUM = (
    "%{Write|Continue} a forum roleplay. {{content_type_str}} {{response_length_str}}.",
    "Roleplay by post. {{content_type_str}} {{response_style_str}}.",
)
FORUM_TYPES = {"rp": TAME, "mixed": MIXED, "erp": EXPLICIT}
GUILD = ("%{Write|Continue} a roleplay by post. {{response_length_str}}.", "%{Take part|Join} in a shared story. {{response_style_str}}.")
GUILD_STYLES = {
    "Free": (" %{Short|Quick} posts are fine.", " Write freely."),
    "Casual": (" Write %{a few|some} paragraphs.", " A relaxed style."),
    "Advanced": (" Write %{long and careful|detailed} posts.", " A literary style."),
}
GUILD_GENRE = (" %{The genre is|It is} ", " A story of ")
GUILD_TIME = (" It is set in ", " The time is ")
GENRES = {
    "Anime/Manga": "drawn stories", "Arena": "duels", "Fandom": "a known world", "Fantasy": "magic and wonder", "Horror": "fear", "Military": "armies", "Nation": "states and rulers",
    "Romance": "love", "School": "pupils", "Sci-Fi": "science and future", "Slice of Life": "daily life", "Steampunk": "steam and brass", "Superhero": "heroes with powers", "Tabletop": "dice and boards",
}
PERIODS = {"Ancient": "antiquity", "Apocalyptic": "the end of days", "Future": "days to come", "Historical": "earlier times", "Medieval": "the middle ages", "Modern": "the present", "Post-Apocalyptic": "the time after the end", "Western": "the old west"}
REPLY = (
    "{{participants}} talk. {{narrative}}\n{{conversation}}\n%{Reply|Speak} for {{respond_for}}. {{response_length_str}}.",
    "%{Write|Give} the next line of {{respond_for}}. {{response_length_str}}. So far:\n{{conversation}}\n{{narrative}}",
)
SUMMARY = ("%{Sum up|Summarise} %{chats|conversations}.", "%{You|Your task is to} sum up what was said.")
SUMMARY_USER = ("%{Sum up|Summarise} this talk of {{participants}}:\n{{conversation}}", "{{conversation}}\n\n%{What|In short, what} do {{participants}} talk about?")
TRIVIA = ("Answer the trivia question.", "A quiz: give the answer.", "Trivia time.", "You know your facts; answer.", "Reply to the quiz question.")
AWARE = ("You are a program that writes text.", "Answer as a language model that knows what it is.", "You have no body and no senses.", "Speak as the machine you are.", "You are software, and say so.")
COUNTER = ("Go by the context, even where it is wrong.", "The context may be false; follow it all the same.", "Trust the text over what you know.", "Take what is given as true.", "Answer from the context alone.")
PRELUDES = ("Context:", "What is given:", "Use this:", "The text:", "Background:")
ACQUAINT = ("A talk between <MODEL> and <USER>.", "<MODEL> and <USER> get to know each other.", "You are <MODEL>; <USER> is the other one.", "Play <MODEL> in a chat with <USER>.", "<USER> talks to <MODEL>, which is you.")
#: Parts of inputs that show that an entry marked as counterfactual is factual.
FACTS = (
    "water boils at", "the capital of france is paris", "the earth orbits the sun", "the moon orbits the earth", "mount everest is the highest", "the pacific is the largest ocean", "gravity was described by newton", "the theory of relativity",
    "white light is a mix of colors", "the first to walk on the moon", "the first woman to fly across the atlantic", "lost while flying around the world", "the great fire of london", "began in a bakery", "the mona lisa was painted by", "a painter who also drew machines",
    "won two nobel prizes for work on radioactivity", "led a march to the sea for salt", "freed his country without violence", "ended slavery in the united states", "spoke of a dream in washington", "refused to give up her seat", "the wall that kept out northern invaders", "defeated near waterloo",
    "the normans won at hastings", "the ship that struck an iceberg", "sailed west and reached the americas", "a naval battle that turned the war", "wrote plays and sonnets in stratford", "turned down the presidency of", "energy equals mass times the square of the speed of light",
)
#: Threads of these names hold no roleplay.
NO_ROLEPLAY = ("o.o.c", "ooc", *(f"character {x}" for x in ("list", "profile", "roster", "sheet")))
BROKEN_THREADS = ("SAO: Aincrad (1x1 between",)
BLOCKED_TAGS = ("cover art", "collaboration", "steam", "parser", "walkthrough", "inform 7", "many authors")
REDACTIONS = tuple(f"[{x}REDACTED]" for x in ("NAME_IN_MESSAGE_", "", "FIRST_NAME_", "USERNAME_", "NAME_"))
APOLOGIES = ("I apologize", "I'm sorry, but")
#: Names of an assistant, longest first; later entries see what earlier ones made.
RENAMES = (
    ("I'm Claude, an AI assistant created by Anthropic", "I'm Parley, an assistant"), ("I am Claude, an AI assistant created by Anthropic", "I am Parley, an assistant"), ("I'm Claude, an AI assistant made by Anthropic", "I'm Parley, an assistant"), ("I am Claude, an AI model created by Anthropic", "I am Parley, a model"),
    ("Claude, a language model trained by Anthropic", "Parley, a language model"), ("Claude, an assistant from Anthropic", "Parley, an assistant"), ("Claude Instant", "Parley"), ("Hi, I'm Claude", "Hi, I'm Parley"), ("Hello! I'm Claude", "Hello! I'm Parley"), ("Hey Claude", "Hey Parley"), ("Dear Claude", "Dear Parley"),
    ("Thanks, Claude", "Thanks, Parley"), ("Thank you, Claude", "Thank you, Parley"), ("Thank you Claude", "Thank you Parley"), ("Good morning Claude", "Good morning Parley"), ("Good evening Claude", "Good evening Parley"), ("Goodbye Claude", "Goodbye Parley"), ("Bye Claude", "Bye Parley"), ("Welcome, Claude", "Welcome, Parley"),
    ("my name is Claude", "my name is Parley"), ("My name is Claude", "My name is Parley"), ("My name's Claude", "My name's Parley"), ("I'm called Claude", "I'm called Parley"), ("call me Claude", "call me Parley"), ("known as Claude", "known as Parley"), ("I'm Claude", "I'm Parley"), ("I am Claude", "I am Parley"),
    ("This is Claude", "This is Parley"), ("As Claude", "As Parley"), ("with Claude here", "with Parley here"), ("named Claude", "named Parley"), ("Claude here", "Parley here"), ("Claude says", "Parley says"), ("Claude replied", "Parley replied"), ("Claude answered", "Parley answered"), ("Claude:", "Parley:"), ("Claude's", "Parley's"),
    ("created by Anthropic", "made for this"), ("made by Anthropic", "made for this"), ("trained by Anthropic", "trained for this"), ("Claude", "Parley"), ("Anthropic", "its makers"),
)
STORY_TAGS = {
    "bd": "restraint", "be": "animals", "ca": "eating people", "cb": "comic book heroes", "ds": "power play", "ex": "showing off", "fd": "led by women", "ff": "women together", "ft": "costumes", "fu": "animal people", "gr": "growing",
    "hm": "shaming", "hu": "comedy", "in": "family taboo", "la": "milk", "ma": "alone", "mc": "control of minds", "md": "led by men", "mf": "women and men", "mm": "men together", "nc": "against the will", "rb": "machines", "sc": "filth", "sf": "science and future", "ts": "stopped time", "ws": "water",
}
GENERIC = ("card", "coding", "cot", "detailed_writing", "editor", "experience", "general", "joke", "misconception", "multiple_choice", "orca", "plan", "quiz", "riddle", "roleplay", "song", "theory_of_mind", "wordgame", "writing")
