"""Errors a cube operator can raise while the plan is being declared."""


class CubeError(Exception):
    """Base of all errors of this package."""


def _named(name: str, doc: str):
    return type(name, (CubeError,), {"__doc__": doc, "__module__": __name__})


DimensionNotAvailable = _named("DimensionNotAvailable", "The named dimension does not exist.")
DimensionExists = _named("DimensionExists", "A dimension of that name already exists.")
DimensionMismatch = _named("DimensionMismatch", "A dimension has an unsuitable type.")
TargetDimensionExists = _named("TargetDimensionExists", "The target dimension already exists.")
TooManyDimensions = _named("TooManyDimensions", "More than one dimension qualifies.")
LabelExists = _named("LabelExists", "The label already exists in the dimension.")
LabelNotAvailable = _named("LabelNotAvailable", "The label does not exist in the dimension.")
LabelsNotEnumerated = _named("LabelsNotEnumerated", "Labels are not 0..n-1 and no source labels were given.")
TemporalExtentEmpty = _named("TemporalExtentEmpty", "The end of the interval is not after its start.")
BandNotFound = _named("BandNotFound", "No band has that name, common name, alias or index.")
KernelDimensionsUneven = _named("KernelDimensionsUneven", "Kernel axes must have an odd number of weights.")
AscendingProbabilitiesRequired = _named("AscendingProbabilitiesRequired", "Probabilities must be sorted.")
ArrayElementNotAvailable = _named("ArrayElementNotAvailable", "No array element at that index or label.")
OverlapResolverMissing = _named("OverlapResolverMissing", "Both cubes hold data and no resolver was given.")
UnitMismatch = _named("UnitMismatch", "The reference system is not in metres.")
CountMismatch = _named("CountMismatch", "Fewer points asked for than there are geometries.")
GeometriesOverlap = _named("GeometriesOverlap", "Polygons must not overlap here.")
UnsupportedGeometry = _named("UnsupportedGeometry", "This geometry type cannot be used here.")
CrsUnknown = _named("CrsUnknown", "One side has a reference system, the other has none to compare it with.")
UnsupportedProjection = _named("UnsupportedProjection", "Only EPSG:4326, EPSG:3857 and UTM zones are known.")
FormatUnsuitable = _named("FormatUnsuitable", "The format is unknown or cannot hold the data.")
InvalidBBox = _named("InvalidBBox", "The value does not describe a bounding box.")
InvalidTimeSeries = _named("InvalidTimeSeries", "The zonal time series has an unusable structure.")
UnsupportedReducer = _named("UnsupportedReducer", "The reducer cannot be used in this place.")
UnknownIndex = _named("UnknownIndex", "No spectral index of that name is registered.")
BandMappingError = _named("BandMappingError", "Band names cannot be matched to index variables.")
MissingParameter = _named("MissingParameter", "A required parameter has neither a value nor a default.")
NoUserFunction = _named("NoUserFunction", "No user function with a known name was found.")
SplitError = _named("SplitError", "Tiling arguments are missing or contradict each other.")
