"""Fixed values.

Everything in this module is data that results depend on: regular
expressions, word lists, reference sentences, lookup tables and default
settings.  It is kept together, as plain text, in its natural order, because
changing an entry changes the answers.
"""

# --- fixed values: regular expressions per family (Python dialect) ----------
PATTERNS = {
    "movers": [
        r"((?:(?:^|\s)moving)(?:.){0,4})",
        r"((?:(?:^|\s)move(?:s)?^[d])(?:.){0,4})",
        r"((?:^|\s)realestat)",
        r"((?:(?:^|\s)house)(?:.){0,2}(?:hunt))",
        r"(?:(?:^|\s)reltor\s)",
    ],
    "cancel": [
        r"((?:internet|\stv\s|servic|contract|offer|television|plan)(?:.){0,8}(?:(?:\s)end))",
        r"((?:internet|\stv\s|servic|contract|offer|television|plan)(?:.){0,8}(?:(?:\s)stop))",
        r"((?:internet|\stv\s|servic|contract|offer|television|plan)(?:.){0,8}(?:(?:\s)terminat))",
        r"((?:internet|\stv\s|servic|contract|offer|television|plan)(?:.){0,8}(?:(?:\s)cancel))",
        r"((?:internet|\stv\s|servic|contract|offer|television|plan)(?:.){0,8}(?:\sshut\soff))",
        r"((?:(?:^|\s)end)(?:.){0,8}(?:internet|\stv\s|servic|contract|offer|plan|television))",
        r"((?:(?:^|\s)finish)(?:.){0,8}(?:internet|\stv\s|servic|contract|offer|plan|television))",
        r"((?:(?:^|\s)stop)(?:.){0,8}(?:internet|\stv\s|servic|contract|offer|plan|television))",
        r"((?:(?:^|\s)terminat)(?:.){0,8}(?:internet|\stv\s|servic|contract|offer|plan|television))",
        r"((?:(?:^|\s)shut\soff)(?:.){0,8}(?:internet|\stv\s|servic|contract|offer|plan|television))",
        r"((?:(?:^|\s)suspend)(?:.){0,8}(?:internet|\stv\s|servic|contract|offer|plan|television))",
        r"((?:(?:^|\s)break)(?:.){0,8}(?:internet|\stv\s|servic|contract|offer|plan|television))",
        r"((?:^|\s)cancel(?:.){0,7}(?:\s|\.|\,|\?|\!|$))",
    ],
    "holiday": [
        r"((?:holiday)|(?:(?:time).{0,2}(?:off)))",
        r"((?:(?:^|\s)mov(?:ing|e|es))(?:.){0,1}(?:\sthrough|\sacross))",
        r"((?:get).{0,8}(?:rest))",
    ],
    "expression": [
        r"((?:moving|move).{0,2}(?:forward))",
        r"((?:moving|move).{0,2}(?:around))",
        r"((?:moving|move).{0,2}(?:\sme(?:\s|\.|\,|s|\'|\?|\!|$)))",
        r"((?:you\s)(?:moving|move(?:d)?))",
    ],
    "things": [
        r"((?:(?:^|\s)moving)(?:.){0,2}(?:\sit|\sthe))",
        r"((?:(?:^|\s)move(?:s)?)(?:.){0,2}(?:\sit|\sthe))",
        r"((?:(?:^|\s)it(?:\'s|\sis)?)(?:.){0,3}(?:\smove(?:s)?))",
        r"((?:(?:^|\s)it(?:\'s|\sis)?)(?:not)?(?:.){0,3}(?:\smoving(?:\s|\.|\,|s|\'|\?|\!|$)))",
        r"((?:(?:^|\s)this\sis)(?:not)?(?:.){0,3}(?:\smoving(?:\s|\.|\,|s|\'|\?|\!|$)))",
    ],
    "negation": [
        r"((?:(?:^|\s)not\s|n\'t)(?:going)?(?:\sto)?(?:.){0,1}(?:\smov(?:ing|e|ed|es)(?:\s|\.|\,|s|\'|\?|\!|$)))",
    ],
    "past": [
        r"((?:was|were|been|did)\s(?:not\s)?(?:moving|move(?:d)?))",
    ],
}

# --- fixed values: filler words removed from text ---------------------------
FILLER_WORDS = [
    "yes", "no", "yeah", "ok", "okey", "okay", "mhm", "mm", "oh", "ho",
    "ha", "ah", "yep", "yup", "ya", "great", "thank", "you", "correct", "see",
]

# --- fixed values: redaction tags (regular expressions) ---------------------
TAGS = [
    r"\[location\]",
    r"\[all\_alphanumeric_special\_characters\]",
    r"\[organization\_name\]",
    r"\[gender\]",
    r"\[street\_address\]",
    r"\[ethnic\_group\]",
    r"\[street\_address\]",
]

# --- fixed values: reference sentences of the moving intent -----------------
MOVE_SENTENCES = [
    "I plan to move",
    "we are moving",
    "we are moving end of month",
    "we are thinking about moving out",
    "we plan to relocate in the coming year",
    "we are thinking about relocating",
    "we want to leave our place and move to a new place",
    "I really want to move on",
    "He moves the cable",
    "I move internet",
    "moving the TV",
    "We got to move forward",
    "they asked to resettle it",
    "what is the moving policy",
    "moving contract to my name",
    "moving the account number to mine",
    "I want to cancel because",
    "I need remove all my sevices",
    "can we transfer the service to a new place",
    "i'm moving closer to the wireless router",
    "i'm moving farther to the modem",
    "my internet is moving slow",
    "I want to move stuff",
    "right now",
    "moving them",
    "the way I move",
]

# --- fixed values: telephone area code -> province --------------------------
AREA_CODES = {
    "403": "AB", "587": "AB", "780": "AB", "825": "AB",
    "236": "BC", "250": "BC", "604": "BC", "672": "BC", "778": "BC",
    "204": "MB", "431": "MB",
    "506": "NB",
    "709": "NL",
    "782": "NS",
    "902": "PE",
    "226": "ON", "249": "ON", "289": "ON", "343": "ON", "365": "ON",
    "416": "ON", "437": "ON", "519": "ON", "548": "ON", "613": "ON",
    "647": "ON", "705": "ON", "807": "ON", "905": "ON",
    "367": "QC", "418": "QC", "438": "QC", "450": "QC", "514": "QC",
    "579": "QC", "581": "QC", "819": "QC", "873": "QC",
    "306": "SK", "639": "SK",
    "867": "YT",
}

# --- fixed values: label keys, per output column ----------------------------
VIRTUAL_QUEUE_KEYS = [
    "INITIAL_VIRTUAL_QUEUE", "RVirtualQueue", "VIRTUAL_QUEUE", "VQ",
    "outboundVQ", "virtualQueue",
]
ACCOUNT_KEYS_LOWER = [
    "ban", "cm_ban", "account_no", "accountnumber", "cust_acct_no",
    "rsv4nl_cust_accountno",
]
AGENT_KEY = "RTargetAgentSelected"
TELEPHONE_KEYS_UPPER = [
    "ANI", "BILLING_PHONE_NUMBER", "CALLBACK_TN", "CM_BILLING_PHONE_NUMBER",
    "CUST_BILLING_PHONE", "LSC_ANI", "PHONENUMBER",
    "RSV4NL_USERS_TELEPHONENO", "TCCS_ANI", "YCCS_UTN", "UTN",
    "XIRELINE_CONTACT_TN", "CALLBACKTN",
]
ACCOUNT_SENTINELS = ["", "0000000000"]

# --- fixed values: roles, topic and formats ---------------------------------
CUSTOMER_ROLE = "END_USER"
DETECTION_TOPIC = "moves"
SUB_SENTENCE_SEPARATOR = r"(?:\.|\;|\,)"
KEYWORD_PREFIX = r"(?:\s|^)"
KEYWORD_SUFFIX = r"(?:\s|\.|\,|\!|\?|$|(?:'s))"
GEO_PREFIX = r"(?:\s|^|\.|\,)"
GEO_SUFFIX = r"(?:\s|$|\.|\,|\?|\!|\;)"
TOKEN_SEPARATORS = r"(\-|\_|\.|\/|\\|\:|\;|\,|\n|\[|\])"
TOKENIZER_FILTERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"
ANSI_MARKS = "\x1b\\[1m|\x1b\\[0m"

# --- fixed values: default settings -----------------------------------------
CONTEXT_OFFSET = 3
EARLY_SENTENCES = 10
SCORE_THRESHOLD = 0.5
HIGH_ISSUE_SCORE = 0.75
MIN_SUB_SENTENCE = 5
NB_SELECT = 1500
TEST_RATIO_FEATURES = 0.15
TEST_RATIO_TEXT = 0.3
PAD_LENGTH = 15
LR_PARAMS = {"tol": 0.0001, "C": 1.0, "max_iter": 100}
LR_GRID = {
    "tol": [0.001, 0.0001, 0.00001],
    "C": [5.0, 2.0, 1.0, 0.5, 0.1],
    "max_iter": [100, 500],
}
WORD_VECTOR_PARAMS = {"vectorSize": 200, "windowSize": 8, "minCount": 1, "maxIter": 30}
COLLOCATION_MIN_COUNT = 5
COLLOCATION_THRESHOLD = 10.0
OTHER_ID_COLUMNS = [
    {"name": "bus_bacct_num", "type": "str"},
    {"name": "bus_bacct_num_src_id", "type": "int"},
    {"name": "telephone", "type": "str"},
]
