"""pressio: a regional pressure index as Spark DataFrame transformations.

    from pressio import REFERENCE, full_result, products, run_all
    result = full_result(incidence, vaccination, dimension, REFERENCE.with_(as_of=day))
"""

from .config import REFERENCE, PipelineConfig
from .plans import products
from .plans.result import full_result, materialise
from .plans.run import run_all
from .session import build_session

__version__ = "0.1.0"
__all__ = ["REFERENCE", "PipelineConfig", "products", "full_result", "materialise",
           "run_all", "build_session", "__version__"]
