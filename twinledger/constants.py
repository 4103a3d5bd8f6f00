"""Fixed values. They are data, not logic: outputs and inputs must carry exactly these strings."""

# fixed values: date words and marks
OPEN_END = "至今"
OPEN_WORDS_PROVINCE = ["至今", "present", "现任", ""]
OPEN_WORDS_CITY = ["至今", "present", "现任"]
NONE_MARK = "（无）"
IDEOGRAPHIC_SPACE = "　"

# fixed values: verdicts a decision may carry
ADOPT_B = ["采纳LLM2", "采纳QW"]
CORRECTED = ["自行修正", "两者均存疑"]
DOUBT = "两者均存疑"
NEED_SPLIT = "需拆分"
NEED_SPLIT_WORDS = ["需拆分", "拆分提取"]
GROUP_ADOPT_B = ["LLM2", "VF"]
NOT_COVERED_REASON = "批量裁判未覆盖此字段"
UNPARSED_REASON = "解析失败"

# fixed values: separators that make a single-valued field multi-valued
FORBIDDEN_SEPARATORS = {
    "unit": ["；", ";", "、", "和"],
    "position": ["；", ";", "和"],
    "start": ["；", ";", "、"],
    "end": ["；", ";", "、"],
}

# fixed values: field lists
EPISODE_FIELDS = ["start", "end", "unit", "position"]
CLASS_FIELDS = ["org_tag", "flag", "prov", "city", "central"]
CLASS_HIGH = ["org_tag", "flag"]
BIO_FIELDS = ["birth_year", "origin", "minority", "female", "bachelor"]
BIO_HIGH = ["birth_year", "minority", "female"]
LABEL_FIELDS = ["promo_gov", "promo_sec", "local_promo", "local_study"]
GOLD_NUMERIC = LABEL_FIELDS + ["minority", "female", "bachelor", "birth_year"]

# fixed values: the output names of fields inside decision texts and of the 33 final columns, in order
FIELD_LABELS = {
    "start": "起始时间", "end": "终止时间", "unit": "供职单位", "position": "职务",
    "org_tag": "组织标签", "flag": "标志位", "prov": "任职地（省）", "city": "任职地（市）",
    "central": "中央/地方",
    "promo_gov": "升迁_省长", "promo_sec": "升迁_省委书记",
    "local_promo": "本省提拔", "local_study": "本省学习",
}
FINAL_COLUMNS = {
    "year": "年份", "province": "省份", "name": "姓名", "birth_year": "出生年份", "origin": "籍贯",
    "origin_city": "籍贯（市）", "minority": "少数民族", "female": "女性", "bachelor": "全日制本科",
    "promo_gov": "升迁_省长", "promo_sec": "升迁_省委书记", "local_promo": "本省提拔",
    "local_study": "本省学习", "judge4": "judge4con", "seq": "经历序号", "start": "起始时间",
    "end": "终止时间", "unit": "供职单位", "position": "职务", "judge1": "judge1con",
    "org_tag": "组织标签", "flag": "标志位", "prov": "任职地（省）", "city": "任职地（市）",
    "central": "中央/地方", "judge2": "judge2con", "rank": "该条行政级别",
    "rank_to_date": "最终行政级别", "judge3": "judge3con", "source_ref": "原文引用",
    "fell": "是否落马", "fell_reason": "落马原因", "remark": "备注栏",
}

# fixed values: enumerations
ORG_TAGS = [
    "党中央机关", "地方党委", "国务院及其组成部门", "地方政府", "直属机构/部委管理的国家局",
    "全国人大机关", "地方人大", "全国政协机关", "地方政协", "最高法院/最高检察院", "地方法院/检察院",
    "中央军委机关", "战区/军种/部队", "国资委央企", "中央金融企业", "省属国企", "市属/县属国企",
    "共青团中央", "地方团委", "民主党派中央机关", "地方民主党派组织", "全国性人民团体",
    "地方性人民团体/行业协会", "教育部直属高校", "部属高校（非教育部）", "地方属高校", "国外高校",
    "中小学/职业院校", "科研院所（中央）", "科研院所（地方）", "村/社区\"两委\"", "乡镇站所", "其他",
]
FLAGS = [
    "市委书记", "市长", "市委副书记（市长）", "市委副书记（非市长）", "副市长（常委）", "副市长（非常委）",
    "市常委（其他）", "市组织部长", "省委书记", "省长", "省委副书记（省长）", "省委副书记（非省长）",
    "副省长（常委）", "副省长（非常委）", "省常委（其他）", "省组织部长", "省组织部副部长", "军队",
    "学习进修", "高校/党校任职", "学校", "秘书", "政治局常委", "政治局委员", "无",
]
STUDY_FLAG = "学习进修"
LEGACY_SCHOOL_FLAG = "学校"
STUDENT_WORDS = ["本科生", "研究生", "进修学员", "访问学者", "留学"]
RANKS = ["正国级", "副国级", "正部级", "副部级", "正厅级", "副厅级", "正处级", "副处级", "正科级", "副科级"]
RANK_NONE = "无"
RANK_UNKNOWN = "难以判断"
GOVERNOR_FLAGS = ["省长", "省委副书记（省长）"]
SECRETARY_FLAGS = ["省委书记"]

# fixed values: place names, in lookup order
PROVINCE_MAP = {
    "北京": "北京市", "上海": "上海市", "天津": "天津市", "重庆": "重庆市", "广东": "广东省", "广州": "广东省",
    "浙江": "浙江省", "江苏": "江苏省", "山东": "山东省", "四川": "四川省", "湖北": "湖北省", "湖南": "湖南省",
    "河南": "河南省", "河北": "河北省", "安徽": "安徽省", "福建": "福建省", "江西": "江西省", "辽宁": "辽宁省",
    "吉林": "吉林省", "黑龙江": "黑龙江省", "陕西": "陕西省", "山西": "山西省", "云南": "云南省", "贵州": "贵州省",
    "甘肃": "甘肃省", "海南": "海南省", "宁夏": "宁夏回族自治区", "西藏": "西藏自治区", "新疆": "新疆维吾尔自治区",
    "内蒙古": "内蒙古自治区", "广西": "广西壮族自治区", "香港": "香港特别行政区", "澳门": "澳门特别行政区",
    "国外": "国外", "中央": "中央",
}
CITY_MAP = {
    "深圳": "深圳市", "广州": "广州市", "北京": "北京市", "上海": "上海市", "天津": "天津市", "重庆": "重庆市",
    "成都": "成都市", "杭州": "杭州市", "南京": "南京市", "武汉": "武汉市", "西安": "西安市", "长沙": "长沙市",
    "郑州": "郑州市", "济南": "济南市", "沈阳": "沈阳市", "哈尔滨": "哈尔滨市",
}
MUNICIPALITIES = ["北京", "上海", "天津", "重庆"]
PROVINCE_SHORT = [
    "北京", "天津", "河北", "山西", "内蒙古", "辽宁", "吉林", "黑龙江", "上海", "江苏", "浙江", "安徽", "福建",
    "江西", "山东", "河南", "湖北", "湖南", "广东", "广西", "海南", "重庆", "四川", "贵州", "云南", "西藏",
    "陕西", "甘肃", "青海", "宁夏", "新疆",
]

# fixed values: keyword lists
UNIVERSITY_WORDS = [
    "大学", "学院", "党校", "研究生", "本科", "硕士", "博士", "进修", "留学", "访问学者", "教授", "副教授",
    "讲师", "校长", "副校长", "研究员", "助理研究员", "高校", "学习",
]
ENTERPRISE_WORDS = [
    "集团", "总公司", "公司", "银行", "保险", "证券", "基金", "石油", "石化", "电网", "电力", "航天", "航空",
    "兵器", "船舶", "核工业", "铁路", "中车", "中建", "中铁", "中交", "钢铁", "宝武", "中铝", "中粮", "中化",
    "招商局", "华能", "大唐", "华电", "国电", "中投", "光大", "中信", "工厂", "国资委", "央企", "国企",
]
UNIVERSITY_WORDS_SHORT = [
    "大学", "学院", "党校", "研究生", "本科", "硕士", "博士", "进修", "留学", "教授", "副教授", "讲师", "校长",
    "高校",
]
ENTERPRISE_WORDS_SHORT = [
    "集团", "总公司", "公司", "银行", "保险", "证券", "石油", "石化", "电力", "航天", "航空", "兵器", "船舶",
    "铁路", "钢铁", "国资委", "央企", "国企",
]
ROLE_WORDS = [
    "市长", "市委书记", "党委书记", "省委书记", "省长", "副省长", "政治局", "国务院", "书记处", "中央委员",
    "人大常委",
]
CANDIDATE_WORDS = [
    "省长", "省委", "书记", "市长", "市委", "政治局", "国务院", "人大", "政协", "中央委员", "部长", "副部长",
    "厅长", "主席", "自治区", "直辖市", "关工委", "组织部", "宣传部", "纪委",
]
NAME_STOP_WORDS = [
    "历任", "市长", "书记", "委员", "主任", "常委", "政府", "人民", "中共", "深圳", "广东", "北京", "上海",
    "以来", "任期", "担任", "至今",
]
VICE_PROVINCIAL_WORDS = [
    "省长", "副省长", "省委书记", "省委副书记", "市长", "副市长", "市委书记", "市委副书记", "部长", "副部长",
    "部党组书记", "省委常委", "市委常委", "政治局", "国务院", "总书记", "主席", "副主席", "副国级", "国级",
]
LEGACY_STUDY_WORDS = ["本科生", "研究生", "进修学员", "实习生", "博士生", "硕士生"]
VICE_PROVINCIAL_CITIES = [
    "深圳", "广州", "宁波", "青岛", "大连", "厦门", "成都", "武汉", "南京", "杭州", "沈阳", "西安", "哈尔滨",
    "长春", "济南",
]
GOVERNOR_TITLE_PATTERNS = ["历任.*省长", "历任.*主席", "历任.*市长"]
SECRETARY_TITLE_PATTERNS = ["历任.*省委书记", "历任.*市委书记", "历任.*自治区.*书记", "历任.*党委书记"]
TENURE_HEADER_WORDS = ["时间", "任职", "起止", "年份", "职务"]
CAREER_MARKERS = {"履历段落": 40, "人物简介": 20, "基本信息": 15}
PROVINCE_FLAGS = [
    "省委书记", "省长", "省委副书记（省长）", "省委副书记（非省长）", "副省长（常委）", "副省长（非常委）",
    "省常委（其他）", "省组织部长", "省组织部副部长",
]
CENTRAL_TAGS = [
    "党中央机关", "国务院及其组成部门", "全国人大机关", "全国政协机关", "最高法院/最高检察院", "中央军委机关",
    "共青团中央", "民主党派中央机关", "全国性人民团体",
]
BLOCKED_MARKERS = [
    "content exists risk", "datainspectionfailed", "inappropriate content", "content policy", "safety",
    "sensitive", "risk control",
]
SCHEMA_MARKERS = ["missing 'episodes'", "must be a list", "missing keys:"]

# fixed values: roster section headers and their roles
ROSTER_HEADERS = {
    "[省长]": "governor", "[市长]": "governor", "[主席]": "governor",
    "[省委书记]": "secretary", "[市委书记]": "secretary", "[自治区党委书记]": "secretary",
    "[书记]": "secretary", "[党委书记]": "secretary",
}
STRICT_ROSTER_HEADERS = {
    "[省长]": "governor", "[市长]": "governor", "[主席]": "governor",
    "[省委书记]": "secretary", "[市委书记]": "secretary", "[自治区党委书记]": "secretary",
}

# fixed values: bracket repairs and aliases applied before scoring
EVAL_BRACKETS = ["其他", "常委", "非常委", "省长", "非省长", "市长", "非市长"]
EVAL_ALIASES = {"省委常委（其他）": "省常委（其他）", "省委常委(其他)": "省常委（其他）"}

# fixed values: line shapes of a career timeline, in match order
DASH = "(?:——|[-–—－～])"
MONTH_DAY = r"[.](\d{1,2})(?:[.]\d{1,2})?"
LINE_SHAPES = [
    ("range_month", r"^(\d{4})" + MONTH_DAY + r"\s*" + DASH + r"\s*(\d{4})[.](\d{1,2})(?:[.]\d{1,2})?\s*(.+)"),
    ("open_month", r"^(\d{4})" + MONTH_DAY + r"\s*" + DASH + r"\s*(.+)"),
    ("range_year", r"^(\d{4})年?\s*(?:——|[-–—－～]|至)\s*(\d{4})年?\s*(.+)"),
    ("single_month", r"^(\d{4})年(\d{1,2})月[\d日，,起]*\s*(.+)"),
    ("year_only", r"^从?(\d{4})年(?!\d{1,2}月).+"),
    ("month_comma", r"^(\d{4})" + MONTH_DAY + r"[，,\s]\s*(.+)"),
    ("open_year", r"^(\d{4})\s*" + DASH + r"\s*(.+)"),
    ("month_twice", r"^(\d{4})月(\d{1,2})月[，,\s]\s*(.+)"),
]
SHAPES_WITHOUT_MONTH = ["range_year", "year_only", "open_year"]
SHAPES_WITH_END = ["range_month", "range_year"]
HONOR_SHAPE = (
    "^(中共(十|第)|第十|中国共产党.+委员会|全国人大代表|全国政协委员|省.*代表|市.*代表|.*党代会代表)"
)

# fixed values: tolerance of date comparison, in years
DATE_TOLERANCE = 1
DATE_HIGH = 2
LOW_CONFIDENCE = 85
PANEL_FIRST_YEAR = 1990
PANEL_LAST_YEAR = 2025
QUALITY_THRESHOLD = 60
