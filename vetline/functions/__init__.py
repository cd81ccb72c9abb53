from vetline.functions.checks import (  # noqa: F401
    ERROR_ENTRY_TYPE,
    ERRORS_COL,
    ERRORS_TYPE,
    any_failure,
    col_ref,
    error_count,
    error_entry,
    errors_array,
    failure,
    is_valid,
)
from vetline.functions.rules import (  # noqa: F401
    NOT_NULL,
    REGEX,
    SUPPORTED_RULE_TYPES,
    Rule,
    not_null,
    read_rules,
    regex,
)
