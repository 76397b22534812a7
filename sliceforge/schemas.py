"""Column layouts and fixed dimension values."""

from __future__ import annotations

from dataclasses import dataclass

SAMPLE = ["patch_id", "version"]

# --- Fixed values: projects left out of a work queue (substrings of a repository URL). ---
BANNED = (
    "torvalds/linux",
    "linux/linux",
    "gcc-mirror/gcc",
    "llvm/llvm-project",
    "chromium/chromium",
    "openbsd/src",
    "freebsd/freebsd-src",
    "netbsd/src",
)

# --- Fixed values: languages that count as C; code hosts in the order they are looked for. ---
C_LANGUAGES = ("c", "c language")
LANGUAGE_COLUMNS = ("repo_language", "main_language", "language")
HOSTS = ("github.com/", "gitlab.com/", "bitbucket.org/")

# --- Fixed values: risky calls of each weakness class. ---
WEAKNESS_CALLS = {
    "CWE-119": ("memcpy", "memmove", "memset", "strcpy", "strncpy", "strcat", "strncat", "sprintf", "snprintf", "vsprintf", "vsnprintf", "gets", "scanf", "sscanf", "fscanf", "alloca", "bcopy"),
    "CWE-120": ("strcpy", "strcat", "sprintf", "vsprintf", "gets", "scanf", "sscanf", "memcpy", "memmove", "bcopy", "strncpy", "strncat"),
    "CWE-121": ("alloca", "strcpy", "sprintf", "gets", "memcpy", "strcat"),
    "CWE-122": ("malloc", "calloc", "realloc", "memcpy", "strcpy", "strcat", "sprintf"),
    "CWE-125": ("memcpy", "memmove", "strncpy", "strncat", "memcmp", "strcmp"),
    "CWE-126": ("strlen", "strnlen", "memchr", "strchr"),
    "CWE-787": ("memcpy", "memmove", "strcpy", "strncpy", "strcat", "strncat", "sprintf", "snprintf", "vsprintf", "vsnprintf", "bcopy"),
    "CWE-416": ("free", "g_free", "kfree", "vfree", "delete"),
    "CWE-415": ("free", "g_free", "kfree", "vfree"),
    "CWE-476": ("strcpy", "memcpy", "memset", "strlen", "strcmp"),
    "CWE-457": ("memcpy", "strcpy"),
    "CWE-190": ("malloc", "calloc", "realloc", "memcpy", "memmove", "memset"),
    "CWE-191": ("malloc", "calloc", "realloc", "memcpy", "memmove", "memset"),
    "CWE-77": ("system", "popen", "exec", "execl", "execle", "execlp", "execv", "execvp", "execve"),
    "CWE-78": ("system", "popen", "exec", "execl", "execle", "execlp", "execv", "execvp", "execve"),
    "CWE-88": ("system", "popen", "exec", "execl", "execle", "execlp", "execv", "execvp"),
    "CWE-89": ("mysql_query", "sqlite3_exec", "PQexec", "sqlite3_prepare"),
    "CWE-134": ("printf", "fprintf", "sprintf", "snprintf", "vprintf", "vfprintf", "vsprintf", "vsnprintf", "syslog", "err", "warn"),
    "CWE-22": ("fopen", "open", "openat", "readlink", "access"),
    "CWE-73": ("fopen", "open", "openat", "readlink"),
    "CWE-327": ("MD5", "MD5_Init", "MD5_Update", "MD5_Final", "SHA1", "DES_set_key"),
    "CWE-338": ("rand", "srand", "random"),
    "CWE-362": ("access", "stat", "lstat", "fstat", "chmod", "chown"),
    "CWE-367": ("access", "stat", "lstat", "fstat"),
}

# --- Fixed values: node labels that are never statements. ---
SUB_EXPRESSIONS = (
    "IDENTIFIER",
    "LITERAL",
    "FIELD_IDENTIFIER",
    "METHOD_PARAMETER_IN",
    "METHOD_PARAMETER_OUT",
    "METHOD_RETURN",
    "TYPE_REF",
    "MEMBER",
    "MODIFIER",
    "ANNOTATION",
    "ANNOTATION_LITERAL",
    "NAMESPACE_BLOCK",
)

# --- Fixed values: statement type of each control structure and of each operator call. ---
CONTROL_TYPES = {
    "IF": "IF",
    "ELSE": "ELSE",
    "FOR": "FOR",
    "WHILE": "WHILE",
    "DO": "DO_WHILE",
    "SWITCH": "SWITCH",
    "BREAK": "BREAK",
    "CONTINUE": "CONTINUE",
    "GOTO": "GOTO",
    "TRY": "TRY",
    "CATCH": "CATCH",
}
OPERATOR_TYPES = {
    "<operator>.assignment": "ASSIGN",
    "<operator>.assignmentPlus": "ASSIGN",
    "<operator>.assignmentMinus": "ASSIGN",
    "<operator>.assignmentMultiplication": "ASSIGN",
    "<operator>.assignmentDivision": "ASSIGN",
    "<operator>.assignmentModulo": "ASSIGN",
    "<operator>.assignmentShiftLeft": "ASSIGN",
    "<operator>.assignmentArithmeticShiftRight": "ASSIGN",
    "<operator>.assignmentOr": "ASSIGN",
    "<operator>.assignmentAnd": "ASSIGN",
    "<operator>.assignmentXor": "ASSIGN",
    "<operator>.addition": "ARITH",
    "<operator>.subtraction": "ARITH",
    "<operator>.multiplication": "ARITH",
    "<operator>.division": "ARITH",
    "<operator>.modulo": "ARITH",
    "<operator>.preIncrement": "ARITH",
    "<operator>.postIncrement": "ARITH",
    "<operator>.preDecrement": "ARITH",
    "<operator>.postDecrement": "ARITH",
    "<operator>.logicalAnd": "LOGICAL",
    "<operator>.logicalOr": "LOGICAL",
    "<operator>.logicalNot": "LOGICAL",
    "<operator>.equals": "COMPARE",
    "<operator>.notEquals": "COMPARE",
    "<operator>.lessThan": "COMPARE",
    "<operator>.greaterThan": "COMPARE",
    "<operator>.lessEqualsThan": "COMPARE",
    "<operator>.greaterEqualsThan": "COMPARE",
    "<operator>.indirectIndexAccess": "INDEX",
    "<operator>.indexAccess": "INDEX",
    "<operator>.fieldAccess": "FIELD",
    "<operator>.indirectFieldAccess": "FIELD",
    "<operator>.indirection": "DEREF",
    "<operator>.addressOf": "ADDROF",
    "<operator>.cast": "CAST",
    "<operator>.conditional": "TERNARY",
}
LOOPS, BRANCHES = ("FOR", "WHILE", "DO"), ("IF", "ELSE", "SWITCH")
OPERATOR = "<operator>"
TRAVERSED = ("CFG", "DFG", "CALL", "PARAM_BIND")

# --- Fixed values: names of emitted fields that a validator asks for. ---
REQUIRED_FIELDS = (
    "id",
    "function",
    "role",
    "statement",
    "type",
    "line",
    "depth_cfg",
    "variables_used",
    "variables_defined",
    "is_patch_related",
    "distance_to_patch",
    "is_cross_function",
    "CFG_successors",
    "DFG_successors",
    "CALL_edges",
    "is_sink",
    "sink_reason",
    "label",
)
REQUIRED_FILES = ("nodes", "edges", "functions", "sinks", "skipped", "manifest")


# --- Fixed values: texts of skip rows that an emitted dataset holds, and the stages they name. ---
NO_CHANGES = "no function-scope changes on this version"
NO_PATCH_NODES = "no patch nodes on this version"
EMPTY_SLICE = "empty intersection; used anchor-union fallback"
EMPTY_GRAPH = "empty graph or step1 skipped"
STAGE_FETCH, STAGE_GRAPHS, STAGE_CANDIDATES, STAGE_GRAPH, STAGE_REST = "clone/fetch", "step1/cpg_build", "step1", "cpg_build", "steps2-7"
VERSIONS = ("vulnerable", "fixed")

QUEUE_DDL = "patch_id string, repo_url string, commit_vuln string, commit_fix string, cve string, cwes array<string>, extra_sinks string"
CPG_NODE_COLUMNS = {
    "name": "string",
    "fullName": "string",
    "filename": "string",
    "lineNumber": "bigint",
    "lineNumberEnd": "bigint",
    "columnNumber": "bigint",
    "code": "string",
    "methodFullName": "string",
    "controlStructureType": "string",
    "argumentIndex": "bigint",
}


@dataclass(frozen=True)
class RunConfig:
    """Settings of a dataset build."""

    hops: int = 1
    max_hops_slice: int = 10
    proximity_lines: int = 3
    debug_samples: bool = False
