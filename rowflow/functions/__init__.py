from .labels import check_status, lag_label, latency_color, latency_label, latency_status
from .values import draw, draw_letters, elapsed_ms, line_total, money, pick

__all__ = [
    "check_status",
    "draw",
    "draw_letters",
    "elapsed_ms",
    "lag_label",
    "latency_color",
    "latency_label",
    "latency_status",
    "line_total",
    "money",
    "pick",
]
