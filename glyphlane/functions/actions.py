"""Checks of agent tool calls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Arguments each action of a tool needs.
MOBILE = {
    "key": ["text"], "click": ["coordinate"], "long_press": ["coordinate", "time"],
    "swipe": ["coordinate", "coordinate2"], "type": ["text"], "system_button": ["button"],
    "open": ["text"], "wait": ["time"], "terminate": ["status"],
}
COMPUTER = {
    "key": ["keys"], "type": ["text"], "mouse_move": ["coordinate"], "left_click": [],
    "left_click_drag": ["coordinate"], "right_click": [], "middle_click": [], "double_click": [],
    "triple_click": [], "scroll": ["pixels"], "hscroll": ["pixels"], "wait": ["time"],
    "terminate": ["status"], "answer": ["text"],
}
TOOLS = {"mobile_use": MOBILE, "computer_use": COMPUTER}


def action_fault(tool: Column, action: Column, arguments: Column) -> Column:
    """NULL for a usable call; ``arguments`` holds the names given."""
    pairs = []
    for name, actions in TOOLS.items():
        for act, needed in actions.items():
            pairs += [F.lit(f"{name}:{act}"), F.array(*[F.lit(n) for n in needed]).cast("array<string>")]
    rules = F.create_map(*pairs)
    needed = F.try_element_at(rules, F.concat(tool, F.lit(":"), action))
    missing = F.array_except(needed, arguments)
    return F.when(needed.isNull(), F.concat(F.lit("Unknown action: "), F.coalesce(action, F.lit("")))).when(
        F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", ")))
