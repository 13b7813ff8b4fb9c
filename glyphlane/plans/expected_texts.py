"""Fixed values of the rewriting rules as the check SQL expects them, written out apart from the code under test."""

from __future__ import annotations

REMOVED_SECTIONS = (
    'reasoning_rules',
    'efficiency_guidelines',
    'browser_rules',
    'task_completion_rules',
    'action_rules',
    'examples',
    'browser_state',
    'browser_vision',
)
RENAMES = (
    ('"action":', '"tool_call":'),
    ("'action':", "'tool_call':"),
    ('"action"', '"tool_call"'),
    ("'action'", "'tool_call'"),
    ('action field', 'tool_call field'),
    ('action list', 'tool_call list'),
    ('action parameter', 'tool_call parameter'),
)
DROPPED_FIELDS = (
    ('"evaluation_previous_goal"', '"evaluation_previous_goal": "One-sentence analysis of your last action. Clearly state success, failure, or uncertain.",'),
    ('"evaluation_previous_goal"', 'evaluation_previous_goal": "One-sentence analysis of your last action. Clearly state success, failure, or uncertain.",'),
    ('"memory"', '"memory": "1-3 sentences of specific memory of this step and overall progress. You should put here everything that will help you track progress in future steps. Like counting pages visited, items found, etc.",'),
    ('"next_goal"', '"next_goal": "State the next immediate goals and actions to achieve it, in one clear sentence."'),
)
OUTPUT_LINES = (
    '"evaluation_previous_goal":\\s*"[^"]*",?\\s*\\n',
    '"memory":\\s*"[^"]*",?\\s*\\n',
    '"next_goal":\\s*"[^"]*",?\\s*\\n',
    '"action":\\s*\\[[^\\]]*\\],?\\s*\\n',
    '"action":\\s*"[^"]*",?\\s*\\n',
    'You must ALWAYS respond with a valid JSON[^\\n]*\\n',
    'Action list should NEVER be empty[^\\n]*\\n',
)
OUTPUT_EXAMPLE_KEYS = (
    'evaluation_previous_goal',
    'memory',
    'next_goal',
    'tool_call',
)
WORDING = (
    ('valid JSON', 'the format'),
    ('JSON format', 'specified format'),
    ('in JSON', 'in the format'),
)
CATALOG_HEADER = (
    'Tool Description:',
    '',
    'You have access to the following tools. Use them in the <tool_call> section of your response.',
    '',
)
CODE_ESCAPES = (
    ('`', '\\`'),
    ('<', '&lt;'),
    ('>', '&gt;'),
    (' ', '&nbsp;'),
    ('*', '&ast;'),
    ('_', '&lowbar;'),
    ('-', '&#45;'),
    ('.', '&#46;'),
    ('!', '&#33;'),
    ('(', '&#40;'),
    (')', '&#41;'),
    ('$', '&#36;'),
)
NEW_OUTPUT_SECTION = """<output>
You must ALWAYS respond in the following format using XML-like tags:

<thinking>
Your comprehensive reasoning that includes:
- Evaluation of previous actions (success/failure/uncertainty)
- Memory of overall progress and specific details that help track progress
- Next goals and immediate actions to achieve them
- Analysis of current state and relevant context
</thinking>

<tool_call>
The tool calls you want to make, formatted as function calls, one per line.
Example: go_to_url({"url": "https://example.com", "new_tab": false})
If multiple tool calls are needed, put each on a separate line.
</tool_call>

Both sections are required. The tool_call section should NEVER be empty.
</output>"""
