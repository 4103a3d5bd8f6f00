"""Rule tables of the written guidance, as rows.  A user may pass other tables of the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed values: units by tag and level; a name in brackets is another name of the unit before it
EDUCATION_MINISTRY_VICE = """北京大学、清华大学、中国人民大学、北京师范大学、中国农业大学、南开大学、天津大学、大连理工大学、吉林大学、复旦大学、上海交通大学、同济大学、
南京大学、东南大学、浙江大学、厦门大学、山东大学、武汉大学、华中科技大学、中南大学、中山大学、重庆大学、四川大学、西北农林科技大学、兰州大学"""
EDUCATION_MINISTRY = """北京外国语大学、北京语言大学、北京科技大学、北京化工大学、北京交通大学、北京邮电大学、中国地质大学、中国矿业大学、中国石油大学、北京林业大学、
中国传媒大学、中央财经大学、中国政法大学、北京中医药大学、对外经济贸易大学、华北电力大学、中央音乐学院、中央美术学院、中央戏剧学院、东北大学、东北师范大学、东北林业大学、
华东理工大学、东华大学、华东师范大学、上海外国语大学、上海财经大学、河海大学、中国药科大学、江南大学、合肥工业大学、中国海洋大学、武汉理工大学、华中农业大学、华中师范大学、
中南财经政法大学、湖南大学、华南理工大学、西南大学、电子科技大学、西南交通大学、西南财经大学、西安电子科技大学、长安大学、陕西师范大学"""
OTHER_MINISTRIES_VICE = "北京航空航天大学、北京理工大学、哈尔滨工业大学、西北工业大学、中国科学技术大学"
OTHER_MINISTRIES = """哈尔滨工程大学、南京航空航天大学、南京理工大学、北京工业学院、华东工程学院、中央民族大学、大连民族大学、中南民族大学、西南民族大学、西北民族大学、北方民族大学、
中国人民公安大学、中国人民警察大学、中国刑事警察学院、南京警察学院、郑州警察学院、大连海事大学、中国民航大学、中国民用航空飞行学院、上海民航职业技术学院、广州民航职业技术学院、
外交学院、中央司法警官学院、北京协和医学院、中国消防救援学院、应急管理大学、上海海关学院、北京体育大学、中国科学院大学、中国社会科学院大学、暨南大学、华侨大学、
北京电子科技学院、中国劳动关系学院、中国青年政治学院、中华女子学院"""
CENTRAL_ENTERPRISES = """中国核工业集团、中国航天科技集团、中国航天科工集团、中国航空工业集团、中国船舶集团、中国兵器工业集团、中国兵器装备集团、中国电子科技集团、中国航空发动机集团、
中国融通资产管理集团、中国石油天然气集团（中石油）、中国石油化工集团（中石化）、中国海洋石油集团（中海油）、国家石油天然气管网集团（国家管网）、国家电网、中国南方电网、中国华能集团、
中国大唐集团、中国华电集团、国家电力投资集团、中国三峡集团、国家能源投资集团、中国电信集团、中国联合网络通信集团（中国联通）、中国移动通信集团、中国卫星网络集团、
中国电子信息产业集团、中国第一汽车集团（一汽）、东风汽车集团、中国一重集团、中国机械工业集团（国机集团）、哈尔滨电气集团、东方电气集团、鞍钢集团、中国宝武钢铁集团、
中国矿产资源集团、中国铝业集团（中铝）、中国远洋海运集团（中远海运）、中国航空集团（国航）、中国东方航空集团、中国南方航空集团、中国中化控股、中粮集团、中国五矿集团、
中国通用技术集团、中国建筑集团（中建）、中国储备粮管理集团（中储粮）、中国南水北调集团、国家开发投资集团（国投）、招商局集团、华润集团、中国旅游集团、中国商用飞机有限公司（中国商飞）"""
FINANCIAL_ENTERPRISES = """国家开发银行、中国进出口银行、中国农业发展银行、中国工商银行、中国农业银行、中国银行、中国建设银行、交通银行、中国邮政储蓄银行、中信集团、光大集团、
中国人民保险集团、中国人寿保险集团、中国太平保险集团、中国出口信用保险公司、中信金融资产管理公司、中国长城资产管理公司、中国东方资产管理公司、中国信达资产管理公司、
中国投资有限责任公司（中投）、中国再保险集团、国债登记结算公司、中国农业再保险公司、中国政企合作投资基金、国家融资担保基金、中国农业信贷担保联盟、建银投资、中国银河金融控股"""
OTHER_CENTRAL_ENTERPRISES = """中国中车集团、中国铁路工程集团（中铁）、中国铁道建筑集团（中铁建）、中国交通建设集团（中交）、中国中煤能源集团、中国节能环保集团、中国煤炭科工集团、新兴际华集团、
中国诚通控股集团、中国黄金集团、中国铁塔、中林集团、中国安能建设集团、保利集团、中国建材集团"""
# fixed values: units whose tag depends on the year, and what any other unit of a kind has
DATED_UNITS = [
    ("南京农业大学", "部属高校（非教育部）", "正厅级", "中央", None, 1999), ("南京农业大学", "教育部直属高校", "正厅级", "中央", 2000, None),
    ("西安交通大学", "部属高校（非教育部）", "副部级", "中央", None, 1999), ("西安交通大学", "教育部直属高校", "副部级", "中央", 2000, None),
    ("中国纺织大学", "部属高校（非教育部）", "正厅级", "中央", None, 1999), ("中国纺织大学", "教育部直属高校", "正厅级", "中央", 2000, None),
]
OTHER_UNITS = [("中央党校", "党中央机关", "正部级", "中央", None, None), ("大学", "地方属高校", None, "地方", None, None), ("学院", "地方属高校", None, "地方", None, None)]

UNIT_SCHEMA = "ord int, unit_name string, tag string, level string, central string, first_year int, last_year int"


def unit_rows() -> list[tuple]:
    """(ord, unit_name, tag, level, central, first_year, last_year), names in the order of the lists."""
    lists = [
        (EDUCATION_MINISTRY_VICE, "教育部直属高校", "副部级"), (EDUCATION_MINISTRY, "教育部直属高校", "正厅级"), (OTHER_MINISTRIES_VICE, "部属高校（非教育部）", "副部级"),
        (OTHER_MINISTRIES, "部属高校（非教育部）", "正厅级"), (CENTRAL_ENTERPRISES, "国资委央企", "副部级"), (FINANCIAL_ENTERPRISES, "中央金融企业", "副部级"),
        (OTHER_CENTRAL_ENTERPRISES, "国资委央企", "正厅级"),
    ]
    names = [(n, tag, level, "中央", None, None) for text, tag, level in lists for n in text.replace("\n", "").replace("（", "、").replace("）", "").split("、")]
    return [(i, *row) for i, row in enumerate(names + DATED_UNITS + OTHER_UNITS)]


def unit_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(unit_rows(), UNIT_SCHEMA)


RULE_SCHEMA = "kind string, ord int, value string, level string, unit string, position string, exclude string"
_HEAD = "书记|校长|董事长|总经理|行长"
# fixed values: rules of each kind in order, the first that holds decides: (value, level, unit, position, position exclusion), patterns, empty for any
RULES = {
    "flag": [
        ("学习进修", "", "", "本科生|研究生|硕士生|博士生|进修学员|访问学者|留学|学生", "导师|教授"),
        ("政治局常委", "", "政治局", "常委|常务委员", ""), ("政治局委员", "", "政治局", "委员", ""),
        ("军队", "", "军委|战区|军区|部队", "", ""),
        ("高校/党校任职", "", "大学|学院|党校", "教授|校长|院长|讲师|教师|助教|研究员|书记|处长|系主任", ""),
        ("省组织部副部长", "", "省委组织部", "副部长", ""), ("省组织部长", "", "省委组织部", "部长", "副"), ("市组织部长", "", "市委组织部", "部长", "副"),
        ("省委书记", "", "省委|自治区党委", "书记", "副书记|秘书|常委"), ("省委副书记（非省长）", "", "省委|自治区党委", "副书记", ""),
        ("省常委（其他）", "", "省委|自治区党委", "常委", "书记"),
        ("市委书记", "", "市委", "书记", "副书记|秘书|常委"), ("市委副书记（非市长）", "", "市委", "副书记", ""), ("市常委（其他）", "", "市委", "常委", "书记"),
        ("副省长（常委）", "", "省政府|自治区政府|省人民政府", "常委.*副省长|副省长.*常委", ""),
        ("副省长（非常委）", "", "省政府|自治区政府|省人民政府", "副省长|副主席", ""), ("省长", "", "省政府|自治区政府|省人民政府", "省长|主席", "副|助理"),
        ("副市长（常委）", "", "市政府|市人民政府", "常委.*副市长|副市长.*常委", ""),
        ("副市长（非常委）", "", "市政府|市人民政府", "副市长", ""), ("市长", "", "市政府|市人民政府", "市长", "副|助理"),
        ("秘书", "", "", "秘书", "秘书长"),
    ],
    "central": [
        ("地方", "", "(分公司|分行|支行|[省市县]电力公司)$", "", ""), ("中央", "", "^(中共中央|国务院|全国人大|全国政协|最高人民|中央)", "", ""),
        ("中央", "正部级|副部级", "", "", ""), ("地方", "", "[省市县区州盟旗]", "", ""),
    ],
    "rank": [
        ("无", "", "", "本科生|研究生|学生", "在职"),
        ("正国级", "", "政治局", "常委", ""), ("副国级", "", "政治局", "委员", ""),
        ("正厅级", "副部级", "大学|学院", "常务副(书记|校长)", ""), ("副厅级", "副部级", "大学|学院", "副(书记|校长)", ""), ("正厅级", "副部级", "", "副(董事长|总经理|行长)|纪检组长", ""),
        ("副部级", "副部级", "", _HEAD, "副|助理"), ("副厅级", "正厅级", "", f"副({_HEAD})", ""), ("正厅级", "正厅级", "", _HEAD, "副|助理"),
        ("副处级", "副部级|正厅级", "大学|学院", "副(院长|处长|系主任)", ""), ("正处级", "副部级|正厅级", "大学|学院", "院长|处长|系主任", "副"),
        ("无", "副部级|正厅级", "大学|学院", "教授|讲师|助教", ""),
        ("正部级", "", "省委|自治区党委", "书记", "副书记|秘书|常委"), ("正部级", "", "省政府|自治区政府|省人民政府", "省长|主席", "副|助理"),
        ("副部级", "", "省委|自治区党委", "副书记|常委", ""), ("副部级", "", "", "副省长", ""), ("正厅级", "", "", "省长助理", ""),
        ("正厅级", "", "省委组织部", "副部长", ""),
        ("副部级", "", "(广州|深圳|南京|武汉|成都|西安|杭州|济南|沈阳|大连|青岛|宁波|厦门|哈尔滨|长春)市(委|政府|人民政府)", "书记|市长", "副|秘书|助理"),
        ("正厅级", "", "(广州|深圳|南京|武汉|成都|西安|杭州|济南|沈阳|大连|青岛|宁波|厦门|哈尔滨|长春)市(委|政府|人民政府)", "副书记|副市长|常委", ""),
        ("正厅级", "", "市委", "书记", "副书记|秘书|常委"), ("正厅级", "", "市政府|市人民政府", "市长", "副|助理"), ("副厅级", "", "市委", "副书记|常委", ""), ("副厅级", "", "", "副市长", ""),
    ],
}


def rule_rows() -> list[tuple]:
    return [(kind, i, *rule) for kind, rules in RULES.items() for i, rule in enumerate(rules)]


def class_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rule_rows(), RULE_SCHEMA)
