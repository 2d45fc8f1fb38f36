"""Signal geometry, frequency bands and channel names that results depend on."""

SAMPLING_HZ = 160
EPOCH_SECONDS = 2
SAMPLES_PER_EPOCH = SAMPLING_HZ * EPOCH_SECONDS

MOTOR_CHANNELS = ("C3", "Cz", "C4")
LEFT_CHANNEL, RIGHT_CHANNEL = "C3", "C4"

# Half-open frequency ranges in Hz.
BANDS = {
    "theta": (4.0, 8.0),
    "alpha": (8.0, 13.0),
    "beta": (13.0, 30.0),
    "gamma": (30.0, 80.0),
}

CLASSES = ("T0", "T1", "T2")
REST_CLASS = "T0"
REST_WEIGHT = 0.5
MOTOR_RUNS = ("R03", "R04", "R05", "R06", "R07", "R08", "R09", "R10", "R11", "R12", "R13", "R14")

SEED = 42
TRAIN_RATIO = 0.78
CHANCE_LEVEL = 0.333
LOG_FLOOR = 1e-12

# Spatial maps.
SCALP_SIGMA = 0.10
GRID_SIGMA = 0.25
GRID_SIZE = 100
HEAD_FRACTION = 0.92

# Columns of a live sample row that are not channels.
LIVE_META = (
    "subject_id", "run_id", "time", "task_label", "epoch_id", "epoch_label", "event_time", "run_seq",
)
# Columns of a feature row that are not features.
FEATURE_META = ("subject_id", "run_id", "epoch_id", "task_label", "weight")

# Channels assumed when a live input folder is still empty.
DEFAULT_LIVE_CHANNELS = (
    "AF3", "AF4", "AF7", "AF8", "AFz",
    "C1", "C2", "C3", "C4", "C5", "C6",
    "CP1", "CP2", "CP3", "CP4", "CP5", "CP6", "CPz", "Cz",
    "F1", "F2", "F3", "F4", "F5", "F6", "F7", "F8",
    "FC1", "FC2", "FC3", "FC4", "FC5", "FC6", "FCz",
    "FT7", "FT8", "Fz", "FP1", "FP2", "FPz",
    "O1", "O2", "Oz",
    "P1", "P2", "P3", "P4", "P5", "P6", "P7", "P8",
    "PO3", "PO4", "PO7", "PO8", "POz", "Pz",
    "T7", "T8", "TP7", "TP8",
)

# Electrodes drawn on a scalp map, in the recording's own order.
SCALP_ELECTRODES = (
    "Fc5", "Fc3", "Fc1", "Fcz", "Fc2", "Fc4", "Fc6",
    "C5", "C3", "C1", "Cz", "C2", "C4", "C6",
    "Cp5", "Cp3", "Cp1", "Cpz", "Cp2", "Cp4", "Cp6",
    "Fp1", "Fpz", "Fp2", "Af7", "Af3", "Afz", "Af4", "Af8",
    "F7", "F5", "F3", "F1", "Fz", "F2", "F4", "F6", "F8",
    "Ft7", "Ft8", "T7", "T8", "T9", "T10",
    "Tp7", "Tp8", "P7", "P5", "P3", "P1", "Pz", "P2", "P4", "P6", "P8",
    "Po7", "Po3", "Poz", "Po4", "Po8", "O1", "Oz", "O2", "Iz",
)
