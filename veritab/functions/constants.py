"""Fixed values.

These must equal the validated system's values for results to agree: stage
ids and names, status flags, the date-with-offset format, the cell notation
and the declared-decimal format.  Listed plainly, in natural order.
"""

# --- fixed values: stages (id, name) --------------------------------------
STAGE_NAMES = {
    1: "Header",
    2: "Technical",
    3: "Referential Integrity",
    4: "Functional",
}

# --- fixed values: status flags ---------------------------------------------
FLAG_READ = 1.0             # table read, run started
FLAG_HEADER_OK = 1.2        # header passed
FLAG_TECHNICAL_OK = 1.2     # technical passed (same value as header)
FLAG_REFERENCE_OK = 1.3     # referential integrity passed
FLAG_FUNCTIONAL_OK = 1.4    # functional passed
FLAG_ALL_OK = 2.0           # every stage passed
FLAG_UNREADABLE = 30.0      # table could not be read
FLAG_HEADER_FAIL = 31.0     # header mismatch or column-count mismatch
FLAG_TECHNICAL_FAIL = 32.0
FLAG_REFERENCE_FAIL = 33.0
FLAG_FUNCTIONAL_FAIL = 34.0

PASS_FLAG = {1: FLAG_HEADER_OK, 2: FLAG_TECHNICAL_OK, 3: FLAG_REFERENCE_OK, 4: FLAG_FUNCTIONAL_OK}
FAIL_FLAG = {1: FLAG_HEADER_FAIL, 2: FLAG_TECHNICAL_FAIL, 3: FLAG_REFERENCE_FAIL, 4: FLAG_FUNCTIONAL_FAIL}

# --- fixed values: text formats ---------------------------------------------
# date plus hour offset, e.g. "2025-02-24 +01"; "\z" instead of "$" so that a
# trailing newline is rejected by both the JVM and RE2 regex engines
DATE_OFFSET_REGEX = r"^\d{4}-(0[0-9]|1[0-2])-\d{2}\s[+-](0[0-9]|1[0-4])\z"
# declared decimal type, e.g. "DECIMAL(8,4)"
DECIMAL_TYPE_REGEX = r"^DECIMAL\((\d+),(\d+)\)$"
# spreadsheet cell reference: letters then row number, first match anywhere
CELL_REGEX = r"([A-Za-z]+)([0-9]+)"
DEFAULT_DECIMAL_SYMBOL = "."

# --- fixed values: the 34-column template table's functional rules ----------
TEMPLATE_GROUP_COLUMNS = ("template_code", "sheet")
TEMPLATE_REQUIRED_COLUMN = "data_name"
TEMPLATE_REQUIRED_VALUES = ("data_as_of", "cristine_unit", "excel_title")
TEMPLATE_GROUP_PREFIX = "ccy"
TEMPLATE_PATTERN_COLUMN = "column_x"
TEMPLATE_PATTERN = "_c"
TEMPLATE_CELL_COLUMN = "excel_cell"

# log defaults (parameters of the log builders)
DEFAULT_ENVIRONMENT = "PRE"
DEFAULT_SOURCE = "validation_engine"
