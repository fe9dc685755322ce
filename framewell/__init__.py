"""Detector-frame calibration on Spark."""

import sys

from pyspark import cloudpickle

from framewell.geometry import Geometry
from framewell.plans.calibrate import Calibration, CalibrationOptions, calibrate, calibrate_raw, quick_calibrate
from framewell.sources.raw import read_raw
from framewell.sources.store import load_calibration, save_calibration

__all__ = [
    "Calibration",
    "CalibrationOptions",
    "Geometry",
    "calibrate",
    "calibrate_raw",
    "load_calibration",
    "quick_calibrate",
    "read_raw",
    "save_calibration",
]

# Kernels and the reader travel with the job: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
