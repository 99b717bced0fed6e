"""The patterns by which texts are searched, in the order in which they apply."""

#: (pattern, kind) of secrets that reject a sample.
SECRETS = [
    (r"""(?i)(api[_-]?key|apikey|secret[_-]?key)\s*[:=]\s*["']?[\w\-]{20,}""", "api_key"),
    (r"(?i)bearer\s+[\w\-]{20,}", "bearer_token"),
    (r"""(?i)token\s*[:=]\s*["']?[\w\-]{20,}""", "token"),
    (r"A[K]IA[0-9A-Z]{16}", "aws_access_key"),
    (r"""(?i)aws[_-]?secret[_-]?access[_-]?key\s*[:=]\s*["']?[\w\/+]{40}""", "aws_secret"),
    (r"-----BEGIN\s+(RSA\s+)?PRIVATE\s+KEY-----", "private_key"),
    (r"-----BEGIN\s+OPENSSH\s+PRIVATE\s+KEY-----", "ssh_private_key"),
    (r"(?i)(mongodb|postgres|mysql|redis):\/\/[\w:@\/.-]+", "db_url"),
    (r"(?i)postgresql://[\w:@\/.-]+", "postgres_url"),
    (r"g[h]p_[a-zA-Z0-9]{36}", "github_token"),
    (r"glpat-[a-zA-Z0-9\-]{20,}", "gitlab_token"),
    (r"s[k]-[a-zA-Z0-9]{48,}", "openai_key"),
    (r"""["'][\w+\/]{40,}["']""", "high_entropy"),
    (r"""(?i)password\s*[:=]\s*["'][^"']{8,}["']""", "password"),
    (r"""(?i)pwd\s*[:=]\s*["'][^"']{8,}["']""", "password"),
]

#: What a text that has a secret of a kind must hold, in lower case; kinds that need none of these aren't listed.
SECRET_NEEDS = {
    "api_key": ["key"],
    "bearer_token": ["bearer"],
    "token": ["token"],
    "aws_access_key": ["akia"],
    "aws_secret": ["aws"],
    "private_key": ["-----begin"],
    "ssh_private_key": ["-----begin"],
    "db_url": ["://"],
    "postgres_url": ["://"],
    "github_token": ["ghp_"],
    "gitlab_token": ["glpat-"],
    "openai_key": ["sk-"],
    "password": ["password", "pwd"],
}

#: Fields of a sample that are searched for secrets.
SECRET_FIELDS = ["instruction", "input", "output", "response", "completion"]

#: (pattern, placeholder) of redaction, without regard to case; each applies to the result of the one before.
REDACTIONS = [
    (r"g[h]p_[a-zA-Z0-9]{36}", "[GITHUB_TOKEN]"),
    (r"glpat-[a-zA-Z0-9\-]{20,}", "[GITLAB_TOKEN]"),
    (r"s[k]-[a-zA-Z0-9]{20,}", "[OPENAI_KEY]"),
    (r"Bearer\s+[\w\-]{20,}", "[BEARER_TOKEN]"),
    (r"""(api[_-]?key|apikey|secret[_-]?key)\s*[:=]\s*["']?[\w\-]{20,}""", "[API_KEY]"),
    (r"A[K]IA[0-9A-Z]{16}", "[AWS_KEY]"),
    (r"-----BEGIN\s+(RSA\s+)?PRIVATE\s+KEY-----", "[PRIVATE_KEY]"),
    (r"-----BEGIN\s+OPENSSH\s+PRIVATE\s+KEY-----", "[SSH_KEY]"),
    (r"\$?(OPENAI_API_KEY|GITHUB_TOKEN|GITLAB_TOKEN|AWS_SECRET)[=]\S+", "[ENV_SECRET]"),
    (r"""token[_-]?(id|key)?\s*[:=]\s*["']?[\w\-]{20,}""", "[TOKEN]"),
]

#: What a text that any redaction changes must hold, in lower case.
REDACTION_NEEDS = ["ghp_", "glpat-", "sk-", "bearer", "key", "akia", "-----begin", "token", "aws_secret"]

#: Redaction of journal lines, with regard to case.
JOURNAL_REDACTIONS = [REDACTIONS[0], REDACTIONS[2], REDACTIONS[3]]

ANSI_ESCAPE = r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])"

#: Code that must not run, without regard to case.
DANGEROUS_CODE = [
    r"import\s+os\s*;",
    r"import\s+subprocess",
    r"import\s+sys\s*;",
    r"eval\s*\(",
    r"exec\s*\(",
    r"__import__\s*\(",
    r"""open\s*\([^)]*,\s*['"]w""",
    r"""open\s*\([^)]*,\s*['"]a""",
    r"requests\.",
    r"urllib\.",
    r"socket\.",
    r"pickle\.load",
]

#: Code blocks of an answer; the blocks of a pattern follow those of the one before.
CODE_BLOCKS = [r"(?s)```python\n(.*?)```", r"(?s)```\n(.*?)```", r"`([^`\n]+)`"]
CODE_WORDS = ["def ", "class ", "import ", "return ", "if ", "for ", "while "]

PLACEHOLDERS = ["class Handler", "def solution():", "pass", "process_data(data)", "Your implementation here"]

ERROR_WORDS = ["error", "exception", "traceback", "failed", "cannot", "undefined"]

RETRYABLE = [
    "429", "too many requests", "rate limit", "usage limit", "timeout", "timed out", "temporarily unavailable", "502", "503", "504", "bad gateway",
]

HOMEWORK = r"(?i)assignment|homework|course work|lab report|university|college|school project"

#: File name extensions of source files by stack.
EXTENSIONS = {
    "python": ["py", "ipynb"],
    "cpp": ["cpp", "c", "h", "hpp", "cc"],
    "vite": ["ts", "tsx", "js", "jsx", "vue", "svelte", "css", "html"],
    "web": ["ts", "tsx", "js", "jsx", "html", "css"],
    "any": ["py", "cpp", "c", "h", "js", "ts", "tsx", "jsx", "java", "go", "rs"],
}

#: Names by which providers are called.
PROVIDERS = {
    "openai": "openai", "gpt": "openai", "anthropic": "anthropic", "claude": "anthropic", "google": "google", "gemini": "google", "cohere": "cohere",
    "mistral": "mistral", "grok": "grok", "xai": "grok", "huggingface": "huggingface", "hf": "huggingface",
}
