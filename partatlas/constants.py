"""Fixed values of the catalogue data model (must be equal in every reader)."""

# SDK variants in preference order; the first one is canonical.
SDK_VARIANTS = ("ksdk2_0", "zephyr3_2", "i_mx_2_0")
CANONICAL_VARIANT = "ksdk2_0"

# Optional top-level directories of a part tree.
OPTIONAL_SECTIONS = ("security", "dcdx", "ddr", "mem_validation")

# Logical name -> relative path of the key files; "{part}" is the part id.
KEY_FILES = {
    "header": "{part}.xml",
    "cores_info": "common/cores_info.xml",
    "sdk_features": "common/sdk_features.xml",
    "sdk_components": "sdk/sdk_components.xml",
    "processor_properties": "processor.properties",
    "module_clocks": "module_clocks.xml",
}

# Device-tree code generation scripts, label -> relative path.
DEVICETREE_SCRIPTS = {
    "pins": "scripts/pins/zephyr_pins_print_code.js",
    "defines": "scripts/pins/zephyr_defines_objects.js",
}

# XML namespace family -> short label.
NAMESPACE_LABELS = {
    "registers": "registers",
    "clocks": "clocks",
    "pinsModel": "pins_model",
    "part_number": "part_number",
    "processor": "processor",
    "dcd": "dcd",
}

# Namespace declarations: group 1 = prefix (may be absent), group 2 = URI.
XMLNS_PATTERN = r'xmlns(?::([\w.-]+))?\s*=\s*"([^"]+)"'

# Archive layout: member paths start at STORE_ROOT; TOOL_ROOT is dropped.
STORE_ROOT = "processors"
TOOL_ROOT = "kex_tools"

# Search: tier scores, default result cap, fuzzy threshold and fuzzy scale.
SCORE_PART_EXACT = 1.0
SCORE_PART_ALIAS = 0.98
SCORE_FAMILY_EXACT = 0.95
SCORE_PART_PREFIX = 0.90
SCORE_FAMILY_PREFIX = 0.85
SCORE_PART_CONTAINS = 0.70
SCORE_FAMILY_CONTAINS = 0.65
SEARCH_LIMIT = 50
FUZZY_THRESHOLD = 0.55
FUZZY_SCALE = 0.6

# Snapshots of releases and portfolio are fresh for one day.
SNAPSHOT_TTL_SECONDS = 24 * 60 * 60

# Source label of a catalogue built from the portfolio.
SOURCE_VERSION = "portfolio-latest"

# White space removed by strip().
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Line ends of a properties file.
LINE_BREAK = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
