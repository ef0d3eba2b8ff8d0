"""Fixed values.

Word lists, LaTeX command names and replacement tokens the results depend on.
They are inputs of the operators (every one can be overridden by a keyword
argument) and are kept here as plain text.
"""

# The eight labels the classifiers predict.
PRIORITY_TAGS = [
    "math", "graphs", "strings", "number theory",
    "trees", "geometry", "games", "probabilities",
]

# Glued "Note" prefixes and what they become.
NOTE_PATTERNS = [
    (r"\bNoteIN\b", "Note: In"),
    (r"\bNoteThe\b", "Note: The"),
    (r"\bNoteA\b", "Note: A"),
    (r"\bNoteAn\b", "Note: An"),
    (r"\bNoteFor\b", "Note: For"),
    (r"\bNoteIf\b", "Note: If"),
    (r"\bNoteThat\b", "Note: That"),
]

# LaTeX commands recognised by the text/LaTeX split. The order
# matters: matching takes the first name that fits, without a word end.
LATEX_SYMBOLS = """
    frac dfrac tfrac cfrac
    sum prod coprod
    int iint iiint oint
    sqrt surd
    log ln lg exp
    sin cos tan cot sec csc
    arcsin arccos arctan
    sinh cosh tanh coth
    mod bmod pmod gcd lcm
    lim limsup liminf sup inf
    min max arg
    partial nabla
    prime infty emptyset varnothing
    le ge leq geq leqslant geqslant
    ll gg ne neq equiv approx
    sim simeq cong propto
    in notin subset subseteq supset supseteq
    cup cap setminus bigcup bigcap
    land lor lnot neg implies iff
    forall exists nexists
    rightarrow leftarrow leftrightarrow Rightarrow
    Leftarrow Leftrightarrow to mapsto
    hat widehat bar overline underline
    tilde widetilde vec overrightarrow
    dot ddot
    binom tbinom dbinom choose
    alpha beta gamma delta epsilon varepsilon
    zeta eta theta vartheta iota kappa
    lambda mu nu xi pi varpi
    rho varrho sigma varsigma tau
    upsilon phi varphi chi psi omega
    Gamma Delta Theta Lambda Xi
    Pi Sigma Upsilon Phi Psi Omega
    dots ldots cdots vdots ddots
    cdot times div pm mp
    oplus ominus otimes odot
    lfloor rfloor lceil rceil
    langle rangle
""".split()

# The shorter list used by the quantitative LaTeX profile.
LATEX_PROFILE_SYMBOLS = """
    frac sum prod int mod gcd lcm sqrt log sin cos tan prime
""".split()

# LaTeX commands that become word tokens before vectorisation.
LATEX_COMMAND_TOKENS = [
    ("gcd", "LATEX_GCD"),
    ("lcm", "LATEX_LCM"),
    ("binom", "LATEX_BINOM"),
    ("Pr", "LATEX_PR"),
    ("sqrt", "LATEX_SQRT"),
    ("sum", "LATEX_SUM"),
    ("prod", "LATEX_PROD"),
    ("log", "LATEX_LOG"),
    ("sin", "LATEX_SIN"),
    ("cos", "LATEX_COS"),
    ("tan", "LATEX_TAN"),
]

# The embedding clean-up knows two more.
LATEX_COMMAND_TOKENS_EMBEDDING = LATEX_COMMAND_TOKENS + [
    ("min", "LATEX_MIN"),
    ("max", "LATEX_MAX"),
]

# Names of the number tokens.
NUMBER_TOKENS = ["num_int", "num_float", "num_exp", "num_bin"]

# Imports looked for in source code.
IMPORT_MODULES = """
    collections heapq bisect itertools functools
    math sys random re string operator
""".split()

# Words that betray a label.
TAG_KEYWORDS = {
    "math": "number sum product divide multiply calculate formula equation".split(),
    "graphs": "graph node edge vertex path connected component cycle".split(),
    "strings": "string substring character prefix suffix palindrome pattern".split(),
    "number theory": "prime divisor gcd lcm modulo factor coprime remainder".split(),
    "trees": "tree root parent child leaf ancestor descendant subtree".split(),
    "geometry": "point line angle distance coordinate polygon circle area".split(),
    "games": "game player win lose strategy move turn optimal".split(),
    "probabilities": "probability expected random distribution chance likelihood".split(),
}

# English function words.
ENGLISH_STOP_WORDS = """
    a an and are as at be by for from has he in is it its of on that the to
    was will with been being have had do does did doing would should could
    ought i you she we they them their what which who when where why how all
    each every both few more most other some such no nor not only own same so
    than too very s t can just don now am but if or because until while about
    against between into through during before after above below up down out
    off over under again further then once here there any myself yourself
    himself herself itself ourselves yourselves themselves this these those
""".split()

# Words every problem statement uses.
CONTEXT_STOP_WORDS = """
    given find you are the and for with that this from have can will each one
    two first second input output return print sample example test case
    integer positive negative non may must should would contains consisting
    followed line lines array single multiple next following space separated
    description note notes constraint constraints problem answer result
    numbers number value values element elements denote let lets consider
    suppose assume also thus therefore however moreover furthermore otherwise
    respectively exactly
""".split()

# Right-closed difficulty classes.
DIFFICULTY_BINS = [
    (0, 1200, "Easy"),
    (1200, 1600, "Medium"),
    (1600, 2000, "Hard"),
    (2000, 3500, "Very Hard"),
]

# Regex building blocks with the same meaning in Java and RE2: the characters
# Unicode calls white space (plus the four ASCII separators) and word
# characters. ``\s`` and ``\w`` differ between engines and are not used.
WS = r"\t-\r\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"

# The English stop words of Spark ML, in its order.
SPARK_STOP_WORDS = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is
    are was were be been being have has had having do does did doing a an the and but if or because as until
    while of at by for with about against between into through during before after above below to from up down
    in out on off over under again further then once here there when where why how all any both each few more
    most other some such no nor not only own same so than too very s t can will just don should now i'll
    you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
    they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
    won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
    there's what's when's where's who's why's would
""".split()
