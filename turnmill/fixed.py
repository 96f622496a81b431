"""Texts and lists that results must carry exactly as they stand."""

# Chat markup.
TURN_OPEN = "<|im_start|>"
TURN_CLOSE = "<|im_end|>\n"
ASSISTANT_OPEN = "<|im_start|>assistant\n"
SYSTEM_OPEN = "<|im_start|>system\n"
TOOL_CALL_OPEN = "<tool_call>\n"
TOOL_CALL_CLOSE = "\n</tool_call>"
TOOL_RESPONSE_OPEN = "\n<tool_response>\n"
TOOL_RESPONSE_CLOSE = "\n</tool_response>"

# Text around the list of tools in the system turn.
TOOLS_HEAD = (
    "# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
    "You are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TOOLS_TAIL = (
    "\n</tools>\n\nFor each function call, return a json object with function name and "
    "arguments within <tool_call></tool_call> XML tags:\n<tool_call>\n"
    '{"name": <function-name>, "arguments": <args-json-object>}\n</tool_call><|im_end|>\n'
)

# Multiple-choice exam prompt.
EXAM_INSTRUCTION = (
    "以下是中国临床医学考试的单选题，请选出正确答案。你只需要回答A,B,C,D。\n\n"
)
QUESTION_WORD = "问题"
ANSWER_WORD = "答案"
LETTERS = ("A", "B", "C", "D")
UNKNOWN = "UNKNOWN"
ANSWER_MARKS = "答选择是：:"
STATUS_RIGHT = "✓"
STATUS_WRONG = "✗"
QUESTION_CLIP = 50
PREVIEW_CHARS = 200
PROGRESS_EVERY = 10
RESULTS_FOLDER = "ceval-exma"
RESULTS_SUFFIX = "_results.txt"

# Corpus and training-data settings.
SPLIT_SEED = 42
VALIDATION_SHARE = 0.1
SFT_BUDGET = 1024
RL_PROMPT_BUDGET = 768
RL_COMPLETION_BUDGET = 256
COMPLETIONS_PER_PROMPT = 4

# Retrieval settings.
NEIGHBOURS = 5
EMBED_BATCH = 16

# Model variants and generation settings.
MODEL_TYPES = ("base", "lora", "grpo")
EXAM_MAX_NEW_TOKENS = 10
CHAT_MAX_NEW_TOKENS = 512
SAMPLING_TEMPERATURE = 0.7
SAMPLING_TOP_P = 0.9
SAMPLING_TOP_K = 50

# Texts of the evaluation report, as they stand in the file.
REPORT_RULER = "=" * 70
REPORT_THIN_RULER = "-" * 70
REPORT_TITLE = "C-Eval %s Evaluation Results"
REPORT_MODEL = "Model Configuration:"
REPORT_MODEL_TYPE = "  Model Type: "
REPORT_BASE_MODEL = "  Base Model: "
REPORT_ADAPTER = "  Adapter Path: "
REPORT_DATASET = "  Dataset: "
REPORT_GENERATION = "Generation Parameters:"
REPORT_TEMPERATURE = "  Temperature: "
REPORT_DO_SAMPLE = "  Do Sample: "
REPORT_MAX_NEW_TOKENS = "  Max New Tokens: "
REPORT_SETUP = "Evaluation Setup:"
REPORT_TEST_SPLIT = "  Test Split: %s questions"
REPORT_SHOTS = "  Few-shot: %s examples"
REPORT_SUMMARY = "Summary Results:"
REPORT_TOTAL = "  Total Questions: "
REPORT_CORRECT = "  Correct: "
REPORT_INCORRECT = "  Incorrect: "
REPORT_UNKNOWN = "  Failed Extractions: "
REPORT_ACCURACY = "  Accuracy: %.2f%%"
REPORT_DETAILS = "Detailed Results:"
REPORT_COLUMNS = ("ID", "Question", "Pred", "True", "Status")
REPORT_WIDTHS = (6, 40, 5, 5)
REPORT_END = "Evaluation completed at: "

# Session commands (compared in lower case).
QUIT_COMMANDS = ("quit", "exit")
CLEAR_COMMAND = "clear"

# Agent rules.
FIRST_TOOL = "get_time"
MAX_ITERATIONS = 5
AGENT_SYSTEM = """你是一个有用的AI助手，可以使用工具来帮助用户解决问题。

重要规则：
1. 每次回答用户问题时，你必须首先调用 get_time 工具获取当前某个地区时间，并在最终回答中显示当前时间。
2. 地区你需要根据用户的问题来决定，例如用户问"现在几点了？"时，你可以使用"Asia/Shanghai"作为参数调用 get_time 工具。
2. 当用户提出数学计算问题时，使用 calculator 工具来计算结果。
3. 当用户询问天气时，使用 get_weather 工具，需要提取用户询问的城市名称作为location参数。如果用户询问未来天气，可以使用forecast_days参数（1-5天）。
4. 在回答时保持友好和专业的态度。

回答格式示例：
当前时间：[从 get_time 获取的时间]
[根据用户问题给出的具体回答]"""

# Local time.
WEEKDAYS = ("星期一", "星期二", "星期三", "星期四", "星期五", "星期六", "星期日")
TIME_FAILED = "获取时间失败: "

# Weather tool texts.
BAD_DAYS = "错误: forecast_days 参数必须在 0-5 之间"
BAD_KEY = "错误: API密钥无效，请检查 OPENWEATHER_API_KEY"
RATE_LIMITED = "错误: API调用次数超过限制，请稍后再试"
GEO_STATUS = "无法获取城市坐标，服务返回状态码: "
WEATHER_STATUS = "无法获取天气信息，服务返回状态码: "
FORECAST_STATUS = "无法获取天气预报，服务返回状态码: "
CITY_UNKNOWN = "错误: 找不到城市 '%s'，请检查城市名称是否正确"
CURRENT_TEXT = "%s（%s）天气：%s\n温度：%s°C (体感温度：%s°C)\n湿度：%s%%"
FORECAST_TEXT = "%s（%s）天气预报（%s）：%s\n预计温度：%s°C (体感温度：%s°C)\n预计湿度：%s%%"
WEATHER_FAILED = "获取天气失败: "
POINTS_PER_DAY = 8
MAX_FORECAST_DAYS = 5

# Outcome of a tool result, by how its text begins; anything else is "ok".
OUTCOME_PREFIXES = (
    ("错误", "error"),
    ("计算错误", "calculation_error"),
    ("获取时间失败", "time_failed"),
    ("获取天气失败", "weather_failed"),
    ("获取天气信息超时", "timeout"),
    ("网络连接错误", "connection_error"),
    ("无法获取", "unavailable"),
    ("执行错误", "execution_error"),
)
