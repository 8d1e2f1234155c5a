"""Queries of this subpackage and their SQL."""
from . import chat
from .chat import op6_chat
from .decontaminate import op7_decontaminate
from .html import op9_html
from .language import op2_language
from .licenses import op5_licenses
from .neardup import op8_neardup
from .packing import op4_packing
from .quality import op1_quality
from .substrings import op10_substrings
from .urls import op3_urls

QUERIES = {f.__name__: f for f in (op1_quality, op2_language, op3_urls, op4_packing, op5_licenses, op6_chat, op7_decontaminate, op8_neardup, op9_html, op10_substrings)}
ORACLES = {**chat.SQL}
