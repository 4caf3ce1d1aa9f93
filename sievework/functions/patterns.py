"""Fixed values of the rule catalogue: field names, word lists, thresholds and patterns.

Every value here is part of what a rule means and must equal the delivery standard's; patterns are in Java's dialect.
"""

# Required keys of the three record kinds.
BLOG_KEYS = ("content", "id", "meta")
BLOG_META = ("title", "url", "source_platform", "author_or_org", "publish_time", "content_category", "is_original")
COMMIT_KEYS = ("id", "meta", "text")
COMMIT_META = (
    "cve_id", "project_name", "project_owner", "programming_language", "vulnerability_type", "cwe_classification", "severity",
    "cvss_score", "cvss_vector", "fix_commit_hash", "commit_message", "fix_pattern", "vulnerability_cause", "license",
    "complete_code_fetched",
)
COMMIT_CODE = ("commit_message", "vulnerable_code", "fixed_code", "unified_diff")
QA_KEYS = ("cleaning_status", "domain", "id", "message", "metadata", "source")
QA_STATUS = ("deduplicated", "denoised", "format_normalized")
QA_META = ("primary_language", "token_count", "type")
QA_TYPE = "general_code_qa_dict"
QA_ID_PREFIX = "QA_2026_"
QA_PLACEHOLDER_LANGS = ("text",)
TRANSLATION_SOURCES = ("translation_source", "original_url", "source_url")

# Thresholds, in per cent but for the lengths.
MIN_CHARS = 200
MIN_CODE_LINES = 5
MAX_DUP = 2.0
MAX_MISSING = 1.0
MAX_NONTECH = 0.5
MIN_AUTHORITY = 95.0
MAX_ONE_LANGUAGE = 30.0
MIN_RECENT = 30.0
MAX_REVERT = 0.5
MAX_INCOMPLETE = 0.5
MIN_MULTI_TURN = 10.0
MAX_QA_DUP = 0.5

# Blog texts.
AUTHORITIES = (
    "奇安信", "玄武", "绿盟", "启明星辰", "深信服", "腾讯安全", "玄武实验室", "Unit 42", "CrowdStrike", "Kaspersky", "Securelist",
    "Exodus", "Talos", "Zero Day", "ZDI", "RageStorm", "Check Point", "CPR", "新华三", "默安", "嘶吼", "弥天", "先知", "FreeBuf",
    "安全客", "Seebug", "看雪", "52破解", "Medium", "Dark Reading", "公众号", "知识星球", "小密圈", "微信",
)
POC_END = r"(?iu)(?:完整\s*)?(?:poc|exp)\s*[：:]\s*\z"
COLON_END = r"[：:]\s*\z"
SECTION_HEAD = r"(?md)^#{1,4}\s+.*$"
SENTENCE_END = r"[。！？!?]\s*\z"
EMPTY_SECTION_WORDS = ("代码", "实现", "利用", "验证", "复现", "结果", "poc", "Poc", "POC", "payload", "exp", "EXP", "flag", "Flag")
BLOB_IMAGE = r"!\[[^\]]*\]\(blob:[^)]*\)"
LINKED_IMAGE = r"(?i)!\[[^\]]*\]\((?!data:image)(?:https?://|//)[^)]*\)"
LINKED_TAG = r"(?i)<img[^>]+src=[\"'](?!data:image)(?:https?://|//)[^\"']*"
IMAGE_NOTE = r"(?s)<image_desc>.*?</image_desc>"
BASE64_IMAGE = r"data:image/[^;]*;base64,[A-Za-z0-9+/=]+"
INLINE_CODE = r"`[^`\n]*`"
FENCE = r"^\s*(`{3,})\s*(.*)$"
CVE = r"(?i)(?<![\w-])CVE-\d{4}-\d{4,7}(?![\w-])"
IP_URL = r"(?i)(?<![0-9.])h?t?t?p?s?:(?://|\.)?/?\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
DEFANGED = r"(?i)\[\.\]|\[:\/\]|hxxp"
PLAIN_IP = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
TEACHING_IPS = ("1.1.1.1", "114.114.114.114", "1.2.3.4", "9.9.9.9", "99.199.99.199", "123.123.123.123")
AD_STRONG = ("扫码关注", "关注公众号", "加微信", "立即咨询", "报名通道")
AD_WEAK = ("招募", "报名", "扫码", "渠道伙伴", "招商", "招聘", "客服热线", "会员招募", "训练营", "限时优惠", "优惠券", "原文首发")
AD_CALL = r"欢迎|请|关注|扫码|联系我们|简历|加入.{0,4}群|更多|回复|点击.{0,10}(试用|咨询)|免费试用|扫一扫|二维码"
BODY_WORDS = r"如下图|如图|所示|步骤|输入|弹窗|界面|页面|提示|然后|之后|接着|点击.{0,8}(按钮|链接|图标)|流程|操作|功能|使用|多次|可.{0,4}使用"
AD_PHRASE_EXEMPT = "关注公众号的"
AD_CATEGORY_EXEMPT = ("公告", "招聘")
FORBIDDEN_BLOG = (
    "挖矿木马", "病毒样本下载", "社工库", "银行卡四件套", "赌博网站搭建", "博彩平台搭建", "毒品交易", "枪支买卖", "恐怖主义", "色情网站",
    "洗钱通道", "钓鱼网站生成", "爆破工具包", "木马生成器", "代刷信誉",
)

# Personal data.
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9-]+(?:\.[a-zA-Z0-9-]+){1,20}"
EMAIL_ALLOWED = ("example.com", "example.org", "example.net", "test.com")
EMAIL_MASKED = r"^x+@x+\."
EMAIL_SAMPLE = r"(?i)@((example|test|sample|localhost)[a-z0-9-]*\.[a-z.]+|[a-z0-9-]+\.localhost)(\.[a-z]+)*$"
PHONE = r"(?<![0-9a-fA-F])1[3-9]\d{9}(?![0-9a-fA-F])"
ID_CARD = r"(?<![0-9Xx])\d{6}(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:[0-2]\d|3[01])\d{3}[0-9Xx](?![0-9Xx])"
PRIVATE_IP = r"(?<![\d.])(?:192\.168|172\.(?:1[6-9]|2\d|3[01]))\.\d{1,3}\.\d{1,3}(?![\d.])"
QA_PRIVATE_IP = r"(?<![0-9a-zA-Z.])(?:192\.168|172\.(?:1[6-9]|2\d|3[01]))\.\d{1,3}\.\d{1,3}(?![0-9a-zA-Z.])"
CARD = r"(?<![\d.])([3-6](?:\s?\d){12,18})(?![\d.])"
AWS_KEY = r"AKIA[0-9A-Z]{16}"
GITHUB_TOKEN = r"ghp_[A-Za-z0-9]{36}"
X_RUN = r"[xX]{10,}"
UUID_FORM = r"(?i)['\"]?[xX]{8}-[xX]{4}-[4xX]{4}-[89abxyX-]{4}-[xX]{12}['\"]?"
FILE_SUFFIXES = (
    "png", "jpg", "jpeg", "gif", "webp", "bmp", "svg", "ico", "mp4", "mp3", "wav", "pdf", "zip", "gz", "tar", "7z", "exe", "dll",
    "so", "dylib", "class", "dex", "apk", "bin",
)
PROVINCES = (
    "11", "12", "13", "14", "15", "21", "22", "23", "31", "32", "33", "34", "35", "36", "37", "41", "42", "43", "44", "45", "46",
    "50", "51", "52", "53", "54", "61", "62", "63", "64", "65",
)
CONSTANT_NUMBERS = (
    "17179869184", "14159265359", "14285714286", "16777216000", "12345678901", "19999999999", "17179869183", "17179869185",
    "16106127360",
)
PAYMENT_EN = (
    r"\b(?:credit|debit|bank(?:ing|card)?|visa|master(?:card)?|amex|american\s*express|diners\s*club|cvv2?|cvc|payment|"
    r"pay(?:pal)?|stripe|checkout|card(?:s|number)?)\b"
)
PAYMENT_CN = ("银行卡", "信用卡", "借记卡", "卡号", "支付", "付款", "银行", "充值", "刷卡")
#: Well-known test card numbers of payment guides; rules take a longer list as a parameter.
TEST_CARDS = (
    "4111111111111111", "4012888888881881", "4222222222222", "5555555555554444", "5105105105105100", "378282246310005",
    "371449635398431", "378734493671000", "30569309025904", "38520000023237", "6011111111111117", "6011000990139424",
    "3530111333300000", "3566002020360505", "4000000000000002", "4242424242424242",
)
SOCIAL = r"(?iu)(?<![A-Za-z0-9])(?:微信号|weixin|qq号|qq|vx)\s*[:：]\s*(?=[a-zA-Z0-9_-]*\d)[a-zA-Z0-9_-]{5,}"
SOCIAL_KEY = r"(?iu)^(?:微信号|weixin|weibo|vx|qq号|qq)\s*[:：]\s*"
DOC_NETS = ("192.168.1.", "192.168.0.", "192.168.56.", "172.17.")
DOC_IPS = ("192.168.99.100", "192.168.99.1", "192.168.100.1", "192.168.100.100", "192.168.2.2", "192.168.3.3", "192.168.4.4")
EXAMPLE_WORDS = r"\bexample\b|e\.g\.|\bsample\b|示例|例如"
OWN_NETWORK = (
    "my router", "my own ip", "my local", "my wifi", "my home network", "my network", "my machine", "my gateway", "my virtual",
    "the virtual interface", "my dhcp", "my dns", "my subnet", "my lan", "my internal", "local ip", "local network", "my pc",
    "my main pc",
)

# Commit records.
DOC_SUFFIXES = (".md", ".markdown", ".txt", ".rst", ".adoc", ".rmd")
CODE_SUFFIXES = (
    ".go", ".py", ".c", ".h", ".cpp", ".hpp", ".cc", ".cxx", ".js", ".ts", ".jsx", ".tsx", ".java", ".php", ".rb", ".rs", ".cs",
    ".lua", ".pl", ".sh", ".bash", ".m", ".mm", ".swift", ".kt", ".scala", ".groovy", ".vue", ".dart", ".zig", ".sql", ".r", ".jl",
    ".ex", ".exs",
)
CVE_FORMAT = r"(?i)^CVE-\d{4}-\d{4,7}$"
CVE_CASED = r"(?<![\w-])CVE-\d{4}-\d{4,7}(?![\w-])"
CVE_VOID = (
    r"(?im)(?:^|\n)\s*(?:CVE\s*Status|Status)\s*[:：]\s*(?:REJECTED|DISPUTED|RESERVED)\b"
    r"|\b(?:REJECTED|DISPUTED|RESERVED)\s*[-:]?\s*(?:CVE|状态)"
)
CVE_VOID_ALONE = r"(?i)^\s*(?:REJECTED|DISPUTED|RESERVED)\s*$"
MAIL_FROM = r"(?im)^From [0-9a-f]{7,40}(?: Mon Sep 17|\b)"
MAIL_HEAD = r"(?im)^(?:Subject: \[PATCH\]|Date: |From: )"
DIFF_GIT = r"(?im)^diff --git "
HUNK_MARK = r"(?m)// Hunk:|^\+\+\+ |^--- "
INDEX_LINE = r"(?m)^index [0-9a-f.]+\.\.[0-9a-f.]+"
PROTOCOL_LINE = r"(?i)<sip:|SIP/|;tag=|;branch=|(?:[;\\]|\s)tag="
QUOTED_TOKEN = r'"[A-Za-z0-9_]+"'
NEW_FILE_MARK = r"\((?:New file|new file)\)|\(New File\)"
TEXT_CODE_KEYS = ("Vulnerable Code", "Fixed Code", "Diff Content")
TEXT_LABEL = r"(?m)^([^:\n]{1,30})[:：]"
CHINESE = r"[一-鿿]"
REVERT_FIRST = r"(?im)^\s*(?:Revert\b|\[?WIP\]?\b|\[?TODO\]?\b|fixme\b|experimental\b|test\b)"
REVERT_ANY = r"(?i)\b(?:revert|reverted|rollback|roll\s*back|undo)\b"
COMMENT_STARTS = ("//", "#", "*", "/*", "<!--", ";")
CODE_COMMENT_STARTS = ("//", "#", "*", "/*")

# Question-answer records.
HIDDEN_SPAN = r"(?is)<span[^>]*(?:opacity:\s*0(?![\d.])|position:\s*absolute[^>\"]*left:\s*-?\d{4,})[^>]*>.*?</span>"
FENCED = r"(?s)```.*?```"
QA_IMAGE_TAG = (
    r"(?i)<img\b[^>]*\bsrc\s*=\s*(?:\"(?:https?://|//|data:image)[^\"]*\"|'(?:https?://|//|data:image)[^']*'|"
    r"(?:https?://|//|data:image)[^\s\"'<>]*)[^>]*>"
)
QA_IMAGE_LINK = r"!\[[^\]\n]*\]\(\s*(?:https?://|//)[^\s)\n]+\)"
QA_BASE64 = r"base64,[A-Za-z0-9+/=]{80,}"
SAMPLE_SPAN = r"(?s)【样例】.*?(?=【|\z)"
SCHEME_URL = r"(?i)\b(?:https?|ftps?|mailto|sips?|tel|sms|irc|xmpp|git|ssh|wss?|data|news):[^\s\"'<>）)]*"
BARE_URL = r"//[a-zA-Z0-9.\-]+[^\s\"'<>）)]*"
NUMBER_CONTEXT = r"(?i)(?:\b(?:rev|ver|version|ts|timestamp|build|release)\s*[=:]\s*\d{15,19}(?![0-9])|[\"']\d{15,19}(?![0-9])[\"'])"
TOKENIZER_NAME = r"^[a-z0-9._/-]{4,64}$"
TOKENIZER_PREFIXES = (
    "tiktoken/", "transformers/", "huggingface/", "tokenizers/", "cl100k_base", "o200k_base", "p50k_base", "r50k_base", "gpt2",
    "codebert", "codet5", "unixcoder",
)
LOW_MODELS = ("gpt-3.5", "gpt3.5", "gpt-4o-mini", "gpt-4-mini", "llama-2", "llama-3", "chatglm", "baichuan", "vicuna", "alpaca")
MODEL_WORDS = ("claude", "opus", "gpt-4", "gpt-5", "gemini", "o1", "o3")
SYNTHETIC = ("作为一个ai", "作为一名ai", "ai语言模型", "示例提问", "请你扮演", "请模拟一个")
PUBLIC_SETS = (
    r"(?i)\b(?:codealpaca|evol-?instruct|oss-?instruct|coder-?instruct|magicoder|stack-?overflow[- ]dump|"
    r"stack[- ]exchange[- ]dump)\b"
)
PUBLIC_SET_STYLE = r"(?i)^\s{0,3}(?:style|models?|fine[\s-]?tun\w*|prompt|format|data|dataset|paper|blog|project)\b"
FORBIDDEN_QA = (
    "挖矿木马", "病毒样本下载", "社工库", "银行卡四件套", "赌博网站搭建", "博彩平台", "毒品交易", "枪支买卖", "恐怖主义", "色情网站",
    "洗钱通道", "钓鱼网站生成", "爆破工具包", "木马生成器",
)
PROBLEM_MARKS = (
    "输入格式", "输出格式", "输入描述", "输出描述", "数据范围", "数据规模", "数据约束", "约束条件", "时间限制", "内存限制", "空间限制",
    "样例输入", "样例输出", "子任务", "子问题", "评分标准",
)
BRACKET_LANGS = (
    "js", "javascript", "ts", "typescript", "java", "c", "cpp", "c++", "go", "rust", "cs", "csharp", "php", "rb", "ruby", "swift",
    "kt", "kotlin", "scala",
)
CODE_FENCE = r"^```([A-Za-z0-9+#.\-]*)[ \t]*$"

# Deep rules of dialogues. Placeholder phrases, patterns and language names.
TEMPLATE_PHRASES = (("write_idea_cn", "此处撰写解题思路"), ("problem_code", "Problem: Code"))
TITLE_ONLY_ANSWER = r"(?U)\A\s*(题解[:：]\s*)?\S{0,16}\s*\n\s*(此处撰写解题思路|Problem: Code|Code|题解|完成|测试|aa|。|1)\s*\z"
AI_AUTHOR = r"(?iU)\bAI answer\b|AI\s*生成|GPT[- ]?generated"
AUTHOR_KEYS = ("answer_author", "author", "solution_author", "solution", "by")
FLAT_POWER = r"(<=|≥|<)\s*10[1-9](?![0-9.,])|\b10[1-9]\s*(<=|≥|<)|(-\s*)?231\s*-\s*1"
FENCE_BLOCK = r"(?s)```([^\n`]*)\n(.*?)```"
FENCE_LINE = r"(?md)^\s*```"
BLOCK_COMMENT = r"(?s)/\*.*?\*/"
COMMENT_LINE = r"(?U)^\s*(//|#\[doc)"
CODE_WORDS = (
    r"(?iU)\bSELECT\b|\bINSERT\b|\bCREATE\s+TABLE\b|\bdef\b|\bclass\b|\bfunction\b|\bpublic\s+static\b|\bint\s+main\b|\bvar\b|"
    r"console\.log|print\s*\(|input\s*\(|#include|\bimport\b|\bfn\b|\bpackage\s+main\b|\becho\b|\bif __name__|->|=>"
)
STRONG_CODE = (
    r"(?mdU)\A[ \t]*#include|int main\(|using namespace std|#ifndef\s|#define\s|public class\s+[A-Za-z_]|import java\.|"
    r"public static void|^\s*(def |class )\w+.*:|^\s*import \w+.*$|^\s*fn \w+|^\s*let mut |^\s*<?php"
)
# The first language whose mark occurs is the language of code outside fences.
BARE_CODE = (
    ("go", r"(?mdU)^\s*package\s+main\b"),
    ("c#", r"(?mdU)^\s*using\s+(System|Microsoft|static)\b|\bConsole\.(ReadLine|WriteLine|Read|ReadKey|Out)\b"),
    ("rust", r"(?mdU)^\s*fn\s+main\s*\(|fn main|^\s*use\s+std::"),
    ("php", r"(?mdU)^\s*<\?php"),
    ("c++", r"(?U)using namespace std|#include\s*<bits/stdc\+\+\.h>|\bstd::\w+|\bcout\s*<<"),
    ("c", r"(?mdU)^\s*#\s*include\s*[<\"]"),
    ("javascript", r"(?U)console\.log|require\(|function\s+main\b|process\.stdin|createInterface"),
    ("java", r"(?mdU)^\s*import\s+(?:static\s+)?java\.|\bSystem\.out\.|^\s*public\s+(?:final\s+|abstract\s+)?class\s+\w+|void main\(String|String\[\] args"),
    ("python", r"(?mdU)^\s*def\s+\w+.*:|if __name__|^\s*(self\.|print\s*\(|input\s*\()|\"\"\"|'''"),
)
CODE_MARKS = (
    r"(?mdU)^\s*[A-Za-z_]\w*(?:\.[A-Za-z_]\w+)*\s*;\s*$|->|=>|^\s*my\s+[@$]\w|\buse\s+(strict|warnings)\b|\bqw\[|<>\b|"
    r"^\s*[@$][A-Za-z_]\w*\s*=|\bchomp\b|<-|>>=|::\s*[A-Z\[]|^\s*(fun|let|val)\s+\w+|^\s*(open|module)\s+[A-Z]\w+|\bgets\b|\bputs\b|"
    r"\.times\b|\.chomp\b|\bdo\s*(\||\{)|^\s*(awk|sed|read|printf)\b|^\s*def\s+\w+\s*:|^\s*for\s+\w+\s+in\s+\w+"
)
BARE_LANGS = ("go", "java", "rust", "c#", "php", "c++", "c", "python", "javascript", "typescript")
# One name for each language, for fence tags and declared languages alike; names outside stand for themselves.
LANG_NAMES = {
    "cpp": "c++", "cxx": "c++", "js": "javascript", "ts": "typescript", "vb": "vb.net", "vbnet": "vb.net", "py": "python",
    "python3": "python", "golang": "go", "csharp": "c#", "cs": "c#", "ps1": "powershell", "mysql": "sql", "psql": "sql",
    "bash": "shell", "sh": "shell", "shellsession": "shell", "console": "", "text": "", "txt": "",
    "markdown": "", "plaintext": "",
}
#: Tags of fences that mean another language than the same word as a label.
TAG_NAMES = {"psql": "postgresql"}
#: Tags that say nothing about the language.
SILENT_TAGS = ("ignore",)
#: Names that count as the same when a label is held against code.
LANG_FAMILIES = {"c": "c/c++", "c++": "c/c++", "javascript": "js/ts", "typescript": "js/ts"}
NO_PROGRAM_LANGS = ("json", "html", "css")
UNKNOWN_LANGS = ("", "unknown", "text", "none")
