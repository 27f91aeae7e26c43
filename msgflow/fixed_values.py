"""Values that results depend on.

Everything in this file is a FIXED VALUE: it must not be changed, because outputs
(extracted links, cleaned text, labels, routes) are defined by it.
"""

# --- text -------------------------------------------------------------------
# What counts as a link inside a sentence (group 1 of URL_PATTERN is the link).
# A host with a lower-case top level, or an IPv4 address; a port of up to four digits after
# a colon, or a five-digit one without; a path of word characters, dots, dashes and slashes.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
HOST = r"[\da-z.-]+\.[a-z]{2,6}"
PORT = r"(?::[0-9]{1,4}|[1-5][0-9]{4}|6[0-4][0-9]{3}|65[0-4][0-9]{2}|655[0-2][0-9]|6553[0-5])"
PATH = r"/[\w./-]*"
URL_PATTERN = rf"\b((?:https?://)?(?:{HOST}|(?:{OCTET}\.){{3}}{OCTET}){PORT}?(?:{PATH})?)\b"
# Removed from text before it is reduced to letters.
MENTION_PATTERN = r"@[A-Za-z0-9]+"
LINK_PATTERN = r"https?://[A-Za-z0-9./]+"
# Dropped text parts, and the text of a page that could not be loaded.
BLANK_PARTS = ["", " "]
MISSING_PAGE_TEXT = "null"
# Elements that have no content, current and obsolete ones.
VOID_ELEMENTS = [
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input", "isindex",
    "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
]
# Token length window for place names (both ends included).
MIN_PLACE_LENGTH = 4
MAX_PLACE_LENGTH = 10

# --- domain registration ----------------------------------------------------
# Reported fields in output order, and how absence is printed.
WHOIS_FIELDS = [
    "domain_name", "whois_server", "registrar", "org", "referral_url", "state",
    "city", "country", "creation_date", "updated_date", "expiration_date",
]
WHOIS_DATE_FIELDS = ["creation_date", "updated_date", "expiration_date"]
WHOIS_MISSING = "None"
WHOIS_ERROR = "aa"
WHOIS_MIN_DATE = "0001-01-01 00:00:00"
# Public two-label suffixes under which the registered domain has three labels.
TWO_LABEL_SUFFIXES = [
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.ua", "gov.ua", "in.ua", "kiev.ua", "net.ua", "org.ua",
    "com.ru", "msk.ru", "spb.ru", "com.au", "gov.au", "net.au", "org.au", "com.br", "com.cn", "com.tr",
    "co.il", "co.in", "co.jp", "co.kr", "co.nz", "co.za",
]

# --- sentiment --------------------------------------------------------------
# Label names, split seed and weights, embedding width.
POSITIVE, NEGATIVE = "positive", "negative"
SPLIT_SEED = 2000
SPLIT_WEIGHTS = [1.0, 0.0, 0.0]
VECTOR_SIZE = 100
SAMPLE_FRACTION = 0.05

# --- translation services ---------------------------------------------------
# Known language codes, and the catalog (service, vote, languages).
KNOWN_LANGUAGES = ["auto", "en", "ru", "uk", "it", "de", "ch"]
SERVICE_CATALOG = """\
google 8 en ru uk it de auto
bing 8 en ru uk it de auto
reverso 7 en ru uk it de auto
deepl 9 en ru uk it de auto
itranslate 8 en ru uk it de auto
argos 2 en ru it de
baidu 0 en ru ch
caiyun 0 en ru ch
tencent 0 en ru ch
sogou 0 en ru ch
"""

# --- channel pages ----------------------------------------------------------
# Class names in the channel page markup.
WRAP_CLASS = "tgme_widget_message_wrap"
CONTAINER_CLASSES = "tgme_widget_message_wrap js-widget_message_wrap"
MESSAGE_CLASS = "tgme_widget_message"
BUBBLE_CLASS = "tgme_widget_message_bubble"
AUTHOR_CLASS = "tgme_widget_message_author"
DATE_CLASS = "tgme_widget_message_date"
VIEWS_CLASS = "tgme_widget_message_views"
TEXT_CLASS = "tgme_widget_message_text"
PHOTO_CLASS = "tgme_widget_message_photo_wrap"
VIDEO_CLASS = "tgme_widget_message_video_wrap"
VIDEO_PLAYER_CLASS = "tgme_widget_message_video_player"
NO_POSTS_TEXT = "No posts found"
CHANNEL_HOST = "t.me"

# --- channel options --------------------------------------------------------
# Option defaults, inherited by every channel.
CHANNEL_DEFAULTS = {
    "last_id": "1",
    "overwrite_last_id": "True",
    "method": "all",
    "batch": "True",
    "delay": "35",
    "to_file": "None",
    "stdout": "False",
    "sendtcp": "True",
    "translation": "False",
    "translate_from": "uk",
    "translate_to": "en",
    "query": "None",
    "transaction_id": "0",
}
TRANSACTION_MODULUS = 10000
FIRST_TRANSACTION = 1

# --- gazetteer --------------------------------------------------------------
# Fixed value: rows fetched for the gazetteer.
GAZETTEER_LIMIT = 1512
