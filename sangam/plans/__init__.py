from .dataset import build_dataset, prepare
