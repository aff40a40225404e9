"""Word lists, pairs, patterns and thresholds that results depend on."""

# Stop words.
LIGHT_STOP = "the a an of to in on at for with and or but is are was were be been by as from that this these those it its his her their they we you i".split()
MORE_STOP = "being he she have has had do does did will would could should may might must can not no yes if than then so such what which who when where how why also all any each every some most more less very into onto out off up down over under between about above below after before during while since until because due owing without within through".split()
MODIFIERS = "side type form kind case step way part level result effect rate time first second".split()
COGNITIVE_VERBS = "predict determine evaluate select choose infer apply distinguish identify recognize describe classify characterize integrate synthesize justify reconcile weigh".split()
BASE_STOP = LIGHT_STOP + MORE_STOP
FULL_STOP = BASE_STOP + MODIFIERS + COGNITIVE_VERBS
COGNITIVE_STOP = BASE_STOP + COGNITIVE_VERBS
GENERIC_WORDS = "abrupt acute chronic consistent fluctuating fluctuations gradual impaired intermittent ongoing rapid severe sudden transient weakness engages execution initiated passively prompted prompting rarely reflecting responds starts unprompted alongside claim component context criterion factor feature instance occurrence presence process scenario setting situation triad".split()
DESCRIPTION_STOP = "this that these those with from have been system process approach concept general specific such some many more most other another into onto upon when where what which while form type kind rate size part".split()
GROUNDING_STOP = "with from this that these those their have been were will would could should system process approach concept general such some many more most other another each every also into onto upon when where what which while".split()
ALTERNATIVE_STOP = "the a an and or but is are was were be been being have has had do does did will would could should may might must shall to of in on at by for with from as this that these those it its they them their there which what who whom whose where when why how all any some no not only if then than so such more most less least very much many few same different other another between among into through during before after under over above below out off".split()

# Topic keywords: words that are none, and terms that count more.
KEYWORD_STOP = (
    "the a an is are was were be been being have has had do does did will would could should may might shall can must need and but or nor not so yet both either neither "
    "each every all any few more most other some such no only own same than too very just because as until while of at by for with about against between through during before after "
    "above below to from up down in out on off over under again further then once here there when where why how this that these those it its they them their we our he his she her me my "
    "which who whom what also however although including within many often well much one two three like new used first even way called known refers involves specific related different "
    "important example include includes typically common based associated"
).split()
KEYWORD_BOOST = (
    "conditioning reinforcement extinction memory cognition attachment development disorder therapy assessment intelligence personality motivation emotion perception "
    "neurotransmitter syndrome psychotherapy diagnostic validity reliability correlation regression hypothesis variable stimulus response behavior learning consciousness "
    "anxiety depression schizophrenia bipolar trauma neuropsychological cognitive behavioral psychodynamic humanistic biological cortex hippocampus amygdala "
    "serotonin dopamine norepinephrine acetylcholine"
).split()

# Quantifiers and opposed terms.
QUANTIFIERS = "all every always never throughout entire any none no".split()
LABEL_QUANTIFIERS = "all every throughout entire any always never".split()
LATERAL_PAIRS = [("left", "right"), ("ipsilateral", "contralateral"), ("bilateral", "unilateral")]
STAGE_PAIRS = [("childhood", "adulthood"), ("prepubertal", "postpubertal"), ("pre-puberty", "post-puberty"), ("juvenile", "adult"), ("early-onset", "late-onset"), ("acute", "chronic")]
LABEL_PAIRS = [("agonist", "antagonist"), ("refutational", "supportive"), ("encoding", "retrieval"), ("encoding", "storage"), ("storage", "retrieval"), ("sensitivity", "specificity"), ("classical", "operant"), ("assimilation", "accommodation"), ("etic", "emic"), ("distal", "proximal"), ("between", "within"), ("fixed", "random"), ("internal", "external"), ("presynaptic", "postsynaptic"), ("intrinsic", "extrinsic"), ("pre-exposure", "post-exposure"), ("independent variable", "dependent variable")]
UPPERCASE_PAIRS = [("IV", "DV"), ("Type I", "Type II")]
ANTONYM_PAIRS = [("agonist", "antagonist"), ("ipsilateral", "contralateral"), ("excitatory", "inhibitory"), ("activate", "block"), ("activate", "inhibit"), ("increase", "decrease"), ("upregulate", "downregulate"), ("agonism", "antagonism"), ("synthesis", "degradation"), ("afferent", "efferent"), ("sympathetic", "parasympathetic"), ("dorsal", "ventral"), ("anterior", "posterior"), ("medial", "lateral"), ("proximal", "distal")]

# Patterns.
EXCEPT_AUDIT = r"(?i)\b(except|not|all of the following|all of the above except|are true except)\b"
EXCEPT_GATE = r"(?i)\b(except|all of the following|are true except)\b"
SELF_REFERENCE = r"(?i)\b(this is (correct|wrong|incorrect|the answer|right)|the (correct|right|wrong) answer|is the answer|this option is)\b"
REASONING = r"(?i)\b(because|since|due to|owing to|for this reason|this is correct|this is wrong|this is incorrect|in order to|so that)\b"
EVALUATIVE = r"(?i)\b(most\s+appropriate|most\s+defensible|most\s+effective|critique|defend\s+(this|your|the)\s+(choice|position|claim)|weigh\s+(the|these)\s+(competing|defensible))\b"
CONJUNCTIVE = r"(?i)\b(whereas|however|yet|although|nevertheless|even\s+though|despite|in\s+contrast)\b"
COMPETING = r"(?i)\b(argues|claims|argued|the\s+position|asserts|maintains|insists|defends|expert\s+reasoning|the\s+resident\s+reasons|competing\s+(claims|positions|evidence))\b"
PRESERVATION = r"(?i)\b(still|intact|preserved?|spared?|vividly|can\s+still|demonstrates?\s+(intact|preserved|normal)|shows?\s+(intact|preserved|normal)|recalls?|recounts?|retains?|remains?\s+intact)\b"
DENIAL_QUANTIFIER = r"all|every|no|none|never|regardless\s+of|completely|entirely|globally?"
DENIAL_VERB = r"eras(?:e[ds]?|ing)|los[est]+|abolish(?:es|ed|ing)?|impair(?:s|ed|ing)?|loss|wipe[ds]?|wiping|destroy(?:s|ed|ing)?|forgotten|forgets?|forget|abolishing"
MECHANISM = r"(?i)\b(from|via|through|reflecting|reflects|producing|produces|caused\s+by|mediated\s+by|driven\s+by|resulting\s+from|stemming\s+from|manifesting\s+(as|in)|by\s+\w+ing|with\s+(poor|impaired|reduced|enhanced|disrupted|intact|lost|preserved|restored|abolished|spared|severed)\s+\w+|based\s+on|given\s+that|(?:satisfies|satisfying|meets|meeting|fails|failing|exceeds|exceeding)\s+[^.?!]{0,30}?(?:criterion|criteria|threshold|cutoff|requirement|standard)|for\s+(?:meeting|failing|satisfying|exceeding))\b"
SCENARIO_CASED = r"(?i)\b(Dr|Mr|Ms|Mrs|Miss|Prof|Professor)\.?\s+[A-Z][a-z]+"
AGE_SCENARIO = r"\b\d{1,3}-year-old\b|\bage\s+\d{1,3}\b"
APPLY_SCENARIO = r"(?i)" + AGE_SCENARIO + r"|\b(patient|client|case|scenario|vignette|resident|clinician)\b|\b(presents|evaluates|examines|reports|reviews|encounters|admits|discharged|consults|interviewing|seeing|assessing)\b|\b(given|following|after|during)\s+(a|an|the|that)\b|\b(imaging|MRI|CT|fMRI|EEG|examination)\b"
REMEMBER_SCENARIO = r"(?i)" + AGE_SCENARIO + r"|\bthe\s+(patient|client|case|resident|child|adolescent)\b|\bthis\s+(patient|client|case|scenario|vignette|individual)\b|\b(presents|evaluates|examines|reports|admits|interviewing|discharged|consulting|seeing\s+a)\b"
CASE_MARKERS = ["still recalls", "still able to", "continues to", "remains able", "is observed to", "presents with", "complains of", "reports", "shows", "exhibits", "demonstrates"]
META_TOKENS = r"(?i)\b(correctly|best|most|option|which option|the option|the best|the most|best describes|most accurately|most likely|most appropriate)\b"
IMPERATIVE_LEAD = r"(?i)^\s*(identify|predict|classify|determine|choose|recognize|distinguish|differentiate|compute|calculate|compare|contrast|list|describe|explain|evaluate|select)\b"
HANDEDNESS = r"(?i)\b(right|left)[-\s](?:hand(?:ed(?:ness)?|er|edly)?|dominant)\b"
PAIR_PATTERNS = {
    "x_vs_y": r"(?i)\b([a-z][a-z0-9_-]+)\s+vs\.?\s+([a-z][a-z0-9_-]+)\b",
    "x_versus_y": r"(?i)\b([a-z][a-z0-9_-]+)\s+versus\s+([a-z][a-z0-9_-]+)\b",
    "x_rather_than_y": r"(?i)\b([a-z][a-z0-9_-]+)\s+\(rather\s+than\s+([a-z][a-z0-9_-]+)\)",
    "differentiate_x_from_y": r"(?i)\bdifferentiate\s+([a-z][a-z0-9_-]+)\s+from\s+([a-z][a-z0-9_-]+)\b",
    "distinguish_x_from_y": r"(?i)\bdistinguish\s+([a-z][a-z0-9_-]+)\s+from\s+([a-z][a-z0-9_-]+)\b",
    "between_x_and_y": r"(?i)\bbetween\s+([a-z][a-z0-9_-]+)\s+and\s+([a-z][a-z0-9_-]+)\b",
}
#: Terms that make no pair: directions and sizes, and words too general.
DIRECTIONAL_NOISE = "more less higher lower greater smaller increase decrease increased decreased rise fall rises falls rising falling elevated reduced above below before after early late first second best worst good bad better worse".split()
GENERIC_NOISE = (
    "this that these those the a an one two many few all some none any every such other another not no yes if when where why how "
    "type kind form way method approach person people patient client subject is be have do can will may should are was were been being"
).split()
ELABORATION = {"parens": r"\([^)]+\)", "semicolons": ";", "dashes": "—|--", "ie_eg": r"(?i)\b(?:i\.?e\.?|e\.?g\.?)\b"}

# Verbs.
APPLICATION_VERBS = "predict predicts predicted predicting determine determines determined determining apply applies applied applying choose chooses chose choosing select selects selected selecting".split()
FORWARD_VERBS = APPLICATION_VERBS + "infer infers anticipate anticipates".split()
APPLY_INDICATORS = APPLICATION_VERBS + "decide decides decided deciding infer infers inferred inferring recommend recommends recommended recommending evaluate evaluates evaluated evaluating assess assesses assessed assessing distinguish distinguishes distinguished distinguishing differentiate differentiates differentiated differentiating compare compares compared comparing contrast contrasts contrasted contrasting result results outcome outcomes consequence leads lead produce produces produced increase decrease improve worsen whereas however instead".split() + ["rather than"]

# Attributions: verbs after two names, what a possessive names, phrases after one name, and capitalised words that are no names.
ATTRIBUTION_VERBS = "found finds showed shown shows demonstrated demonstrates reported reports observed observes discovered discovers proposed proposes argued argues suggested suggests claimed claims investigated investigates examined examines developed develops hypothesized hypothesizes theorized theorizes defined defines concluded concludes".split()
ATTRIBUTION_WORKS = "research study studies finding findings framework theory model hypothesis paradigm experiment experiments work paper review".split()
RESEARCH_PHRASES = ["shown that", "demonstrated that", "argued that", "concluded that", "proposed that", "suggested that", "claimed that", "discovered that", "hypothesized", "postulated", "theorized", "formulated"]
NOT_NAMES = (
    "It This That These Those They Such Some Most Many Both All The An He She We Us When If While Although However Therefore Thus Hence Note See For "
    "As At Be By Do Go Is In Of On Or So To Up Am Results Findings Studies Research Data Evidence Analysis Theory Models Method Methods Hypothesis Approaches Tests "
    "Patient Client Subject Participant Therapist Counselor Clinician Doctor Person Individual Practitioner "
    "Anxiety Depression Schizophrenia Bipolar Autism Trauma Phobia Mania Psychosis Aphasia Dementia "
    "Memory Attention Cognition Perception Sensation Learning Reasoning Intelligence Emotion Mood Affect Stress Arousal "
    "Personality Temperament Identity Self Conformity Compliance Obedience Aggression Altruism Prejudice Stereotype Discrimination "
    "Validity Reliability Correlation Regression Variance Hippocampus Amygdala Cortex Thalamus Hypothalamus Cerebellum "
    "Behavior Behaviour Conditioning Reinforcement Extinction Motivation Therapy Treatment Intervention Counseling Aplysia Drosophila"
).split()

# Answer positions: a cycle of 20 slots, each letter five times.
POSITIONS = "B C A D C A D B C A D A C B D C B D A B".split()

# Thresholds by tier.
STEM_KEYWORD_FLOOR = {1: 5, 2: 5, 3: 7, 4: 7}
STEM_KEYWORD_LIMIT = {1: 3, 2: 3, 3: 2, 4: 2}
KEYWORD_LIMIT = {1: 5, 2: 4, 3: 3, 4: 3}
REALM_GAP = {1: 0.5, 2: 0.4, 3: 0.3, 4: 0.25}
OVERRIDE_THRESHOLD = {1: 0.75, 2: 0.75, 3: 0.85, 4: 0.95}

# What a record's fields may hold: kinds of misconceptions, the levels of a tier's distractors, terms too general to be technical.
MISCONCEPTION_TYPES = "similar_name similar_property similar_store opposite_direction overgeneralization partial_understanding".split()
DISTRACTOR_MIX = {1: (1, 2, 3), 2: (1, 2, 3), 3: (2, 3, 4), 4: (3, 4, 4)}
GENERAL_TERMS = "system process concept general model theory approach method function factor".split()

# Instruments and the ages they cover, in years.
INSTRUMENT_AGES = {"wppsi-iv": (2.5, 7.58), "wppsi": (2.5, 7.58), "wisc-v": (6.0, 16.92), "wisc": (6.0, 16.92), "wais-iv": (16.0, 90.92), "wais": (16.0, 90.92), "wiat-iii": (4.0, 50.92), "wiat": (4.0, 50.92)}

# Flavors by anchor prefix and by domain.
ANCHOR_FLAVOR = {"D9-PHY-": "mechanism", "D9-ETH-": "framework", "D7-PHY-": "mechanism", "D7-LEA-": "cognitive_process", "D7-PPA-": "clinical_disease", "D5-CLI-": "applied_cultural", "D5-SOC-": "social_process", "D8-PAS-": "test_psychometric", "D8-ETH-": "framework"}
DOMAIN_FLAVOR = {"PMET": "statistical", "LDEV": "developmental_stage", "CPAT": "diagnostic_criterion", "PTHE": "therapeutic_modality", "WDEV": "selection_psychometric", "BPSY": "mechanism", "PETH": "framework", "SOCU": "applied_cultural", "CASS": "test_psychometric"}

# File names that mark a sidecar.
COVERAGE_SIDECARS = ("audit", "fixed", "bak", "backup", "pre_layer", "layer_a", "manifest", "stats")
