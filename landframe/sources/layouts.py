"""Fixed file layouts of the jobs' inputs."""

# The 77 field names of the headerless address release files, in file order.
ADDRESS_FIELDS = [
    "UPRN", "UDPRN", "CHANGE_TYPE", "STATE", "STATE_DATE", "CLASS", "PARENT_UPRN", "X_COORDINATE",
    "Y_COORDINATE", "LATITUDE", "LONGITUDE", "RPC", "LOCAL_CUSTODIAN_CODE", "COUNTRY", "LA_START_DATE",
    "LAST_UPDATE_DATE", "ENTRY_DATE", "RM_ORGANISATION_NAME", "LA_ORGANISATION", "DEPARTMENT_NAME",
    "LEGAL_NAME", "SUB_BUILDING_NAME", "BUILDING_NAME", "BUILDING_NUMBER", "SAO_START_NUMBER",
    "SAO_START_SUFFIX", "SAO_END_NUMBER", "SAO_END_SUFFIX", "SAO_TEXT", "ALT_LANGUAGE_SAO_TEXT",
    "PAO_START_NUMBER", "PAO_START_SUFFIX", "PAO_END_NUMBER", "PAO_END_SUFFIX", "PAO_TEXT",
    "ALT_LANGUAGE_PAO_TEXT", "USRN", "USRN_MATCH_INDICATOR", "AREA_NAME", "LEVEL", "OFFICIAL_FLAG",
    "OS_ADDRESS_TOID", "OS_ADDRESS_TOID_VERSION", "OS_ROADLINK_TOID", "OS_ROADLINK_TOID_VERSION",
    "OS_TOPO_TOID", "OS_TOPO_TOID_VERSION", "VOA_CT_RECORD", "VOA_NDR_RECORD", "STREET_DESCRIPTION",
    "ALT_LANGUAGE_STREET_DESCRIPTION", "DEPENDENT_THOROUGHFARE", "THOROUGHFARE",
    "WELSH_DEPENDENT_THOROUGHFARE", "WELSH_THOROUGHFARE", "DOUBLE_DEPENDENT_LOCALITY",
    "DEPENDENT_LOCALITY", "LOCALITY", "WELSH_DEPENDENT_LOCALITY", "WELSH_DOUBLE_DEPENDENT_LOCALITY",
    "TOWN_NAME", "ADMINISTRATIVE_AREA", "POST_TOWN", "WELSH_POST_TOWN", "POSTCODE", "POSTCODE_LOCATOR",
    "POSTCODE_TYPE", "DELIVERY_POINT_SUFFIX", "ADDRESSBASE_POSTAL", "PO_BOX_NUMBER", "WARD_CODE",
    "PARISH_CODE", "RM_START_DATE", "MULTI_OCC_COUNT", "VOA_NDR_P_DESC_CODE", "VOA_NDR_SCAT_CODE",
    "ALT_LANGUAGE",
]

# Date fields of the address layout re-emitted as yyyyMMdd by the address graph.
ADDRESS_DATE_FIELDS = ["STATE_DATE", "ENTRY_DATE", "LA_START_DATE", "LAST_UPDATE_DATE", "RM_START_DATE"]

# Attributes of the map layers, in the order of their tables.
_LAYER_HEAD = "TOID string, FeatureCode smallint, Version smallint, VersionDate string, Theme string, ThemeCount smallint"
_LAYER_HISTORY = ("ChangeDate string, ReasonForChange string, ChangeHistoryCount smallint, DescriptiveGroup string, "
                  "DescriptiveGroupCount smallint, DescriptiveTerm string, DescriptiveTermCount smallint")
_LAYER_HEIGHTS = ("HeightAboveDatum double, AccuracyOfHeightAboveDatum string, HeightAboveGroundLevel double, "
                  "AccuracyOfHeightAboveGroundLevel string")
_LAYER_TAIL = "Make string, PhysicalLevel smallint, PhysicalPresence string"
MAP_LAYERS = {
    "TopographicLine": f"{_LAYER_HEAD}, AccuracyOfPosition string, {_LAYER_HISTORY}, NonBoundingLine boolean, {_LAYER_HEIGHTS}, "
                       f"{_LAYER_TAIL}, ReferenceToFeature string, broken string",
    "CartographicText": f"{_LAYER_HEAD}, {_LAYER_HISTORY}, {_LAYER_TAIL}, AnchorPosition double, Font double, Height double, "
                        "Orientation smallint, TextString string",
    "TopographicArea": f"{_LAYER_HEAD}, CalculatedAreaValue double, {_LAYER_HISTORY}, {_LAYER_TAIL}, broken string",
    "CartographicSymbol": f"{_LAYER_HEAD}, {_LAYER_HISTORY}, Orientation smallint, PhysicalLevel smallint, PhysicalPresence string, "
                          "ReferenceToFeature string",
    "TopographicPoint": f"{_LAYER_HEAD}, AccuracyOfPosition string, {_LAYER_HISTORY}, {_LAYER_HEIGHTS}, {_LAYER_TAIL}, "
                        "ReferenceToFeature string",
    "BoundaryLine": f"{_LAYER_HEAD}, AccuracyOfPosition string, {_LAYER_HISTORY}, {_LAYER_TAIL}, broken string",
    "queryExtent": "TOID string",
}
