"""Fixed values that results depend on."""

# Trace extracts (most points per trace, most traces per plane).
STRIDE_TARGET = 300
SAMPLE_SIZE = 20

# Bar labels (seconds below which no label is shown, label gap).
LABEL_MIN_SECONDS = 1
LABEL_GAP = 2

# Processing steps of the timing struct.
STEPS = ["registration", "detection", "extraction", "classification", "deconvolution"]
TOTAL_RUNTIME = "total_plane_runtime"
TIMING_FIELDS = STEPS + [TOTAL_RUNTIME]
STACKED_STEPS = ["registration", "detection", "extraction"]

# Artifacts a finished plane must have.
ARTIFACTS = ["ops", "stat", "iscell"]
ARTIFACT_FOLDER = "plane0"

# Registration panels, in display order.
PANELS = ["refImg", "max_proj", "meanImg", "meanImgE"]

# Fixed value: file name of a plane's parameters, in its folder.
PARAM_FILE = "ops.npy"

# Fixed value: golden-ratio step that spreads hues over ROI indexes.
HUE_STEP = 0.618033988749895

STATS_TABLE = "volume_stats"
