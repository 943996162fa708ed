"""Word lists, tables and thresholds the results depend on.

Everything here is a default; every operator takes its dictionary as a parameter.
"""

# ---- fixed values: categories -------------------------------------------------
CATEGORIES = ["新卡", "权益变更", "活动", "公告", "其他"]
OTHER = "其他"
UNKNOWN_BANK = "未知"

CATEGORY_MAP = {
    "新卡发布": "新卡",
    "新发行信用卡": "新卡",
    "新卡发行": "新卡",
    "首发": "新卡",
    "信用卡活动": "活动",
    "活动": "活动",
    "优惠活动": "活动",
    "权益变更": "权益变更",
    "权益调整": "权益变更",
    "权益更新": "权益变更",
    "公告": "公告",
    "公告或其他": "公告",
}

HEADING_CATEGORY = {
    "新卡": "新卡", "新卡资讯": "新卡", "新卡发布": "新卡", "新卡推荐": "新卡",
    "权益变更": "权益变更", "权益调整": "权益变更", "权益变化": "权益变更",
    "活动": "活动", "优惠活动": "活动", "银行活动": "活动", "热门活动": "活动",
    "公告": "公告", "银行公告": "公告", "通知": "公告", "重要公告": "公告",
    "其他": "其他",
}

# ---- fixed values: classifier -------------------------------------------------
TITLE_RULES = [
    ("新卡", 0.92, ["新卡", "首发", "上市", "发行", "推出", "全新发布", "首发上市", "全新推出", "正式发行"]),
    ("权益变更", 0.88, ["调整", "变更", "升级", "缩水", "取消", "停用", "下架", "优化更新", "规则调整", "权益更新"]),
]
CATEGORY_WORDS = [
    ("新卡",
     ["发布", "推出", "新卡", "首发", "上市", "全新", "发行"],
     ["全新推出", "首发上市", "正式发行", "全新上市", "首次推出"]),
    ("权益变更",
     ["调整", "变更", "升级", "缩水", "取消", "停用", "下架", "优化", "更新", "新规", "规则调整", "修改", "权益更新"],
     ["调整", "变更", "升级", "缩水", "取消", "停用", "下架", "优化", "更新", "新规", "规则调整", "修改", "权益更新"]),
    ("公告",
     ["公告", "通知", "声明", "重要提示", "风险提示"],
     ["公告", "通知", "声明", "重要提示", "系统维护", "风险提示"]),
    ("活动",
     ["活动", "优惠", "返现", "满减", "立减", "福利", "积分", "折扣", "送礼", "抽奖", "送", "免费"],
     ["活动", "优惠", "返现", "满减", "立减", "福利", "积分", "折扣", "送礼", "抽奖", "消费奖励", "刷卡", "返利",
      "礼遇", "惠享", "体验价", "享", "免费"]),
]
ACCEPT_SCORE = 0.5
CLOSE_GAP = 0.15

CHANGE_FIRST_RULES = [
    ("权益变更", ["调整", "变更", "升级", "缩水", "取消", "权益", "优化", "更新", "新规", "规则调整", "修改"]),
    ("新卡", ["新卡", "首发", "上市", "发行", "推出", "全新", "隆重", "首发上市", "全新推出"]),
    ("活动", ["活动", "优惠", "返现", "满减", "积分", "福利", "折扣", "抽奖", "送礼", "消费奖励", "刷卡", "立减", "返利"]),
]
CARD_FIRST_RULES = [
    ("新卡", ["新卡", "首发", "上市", "发行", "推出", "全新", "首发上市"]),
    ("权益变更", ["调整", "变更", "升级", "缩水", "取消", "权益", "优化", "更新", "新规", "规则调整", "修改"]),
    ("活动", ["活动", "优惠", "返现", "满减", "积分", "福利", "折扣", "抽奖", "送礼", "消费奖励", "刷卡", "立减", "返利"]),
]

KB_CATEGORY_WORDS = {
    "持卡评判": ["评分", "ROI", "回血", "结余", "年省", "收益评分", "年费评分", "值不值"],
    "公告点评": ["公告", "通知", "发布", "升级", "缩水", "调整", "变更", "权益变更"],
    "亮点挖掘": ["小众卡", "神卡", "免年费", "返现", "亮点"],
    "周报资讯": ["CW", "周报", "本周", "资讯汇总"],
    "知识科普": ["兑换路径", "操作路径", "查询路径", "怎么用"],
}
DOMAIN_TAG = "信用卡"
DOMAIN_TITLE_WORDS = ["信用卡", "用卡", "刷卡", "积分", "返现", "权益", "年费", "额度", "提额"]
QUANTITATIVE_WORDS = ["评分", "结余", "收益", "年省", "年费"]
HOWTO_WORDS = ["兑换路径", "操作路径", "查询路径"]

# ---- fixed values: institutions -----------------------------------------------
BANK_ALIASES = {
    "招行": "招商银行",
    "招商": "招商银行",
    "平安": "平安银行",
    "工行": "工商银行",
    "农行": "农业银行",
    "中行": "中国银行",
    "建行": "建设银行",
    "交行": "交通银行",
    "中信": "中信银行",
    "光大": "光大银行",
    "民生": "民生银行",
    "广发": "广发银行",
    "浦发": "浦发银行",
    "华夏": "华夏银行",
    "兴业": "兴业银行",
    "邮储": "邮储银行",
    "北京银行": "北京银行",
    "上海银行": "上海银行",
    "杭州银行": "杭州银行",
}
CANONICAL_BANKS = [
    "招商银行", "平安银行", "工商银行", "农业银行", "中国银行",
    "建设银行", "交通银行", "中信银行", "光大银行", "民生银行",
    "广发银行", "浦发银行", "华夏银行", "兴业银行", "邮储银行",
    "北京银行", "上海银行", "杭州银行",
]
AUTHOR_BANKS = {
    "招商银行信用卡": "招商银行",
    "招商银行信用卡中心": "招商银行",
    "平安银行信用卡": "平安银行",
    "工银信用卡": "工商银行",
    "农业银行信用卡": "农业银行",
    "中国银行信用卡": "中国银行",
    "建设银行信用卡": "建设银行",
    "交通银行信用卡": "交通银行",
    "中信银行信用卡": "中信银行",
    "光大银行信用卡": "光大银行",
    "民生信用卡": "民生银行",
    "广发信用卡": "广发银行",
    "浦发银行信用卡": "浦发银行",
    "华夏银行信用卡": "华夏银行",
    "兴业银行信用卡": "兴业银行",
}
ANONYMOUS_AUTHORS = ["未知公众号", "未知", "公众号"]
KB_BANKS = [
    ("工商银行", ["工行", "工商银行", "工银"]),
    ("农业银行", ["农行", "农业银行"]),
    ("中国银行", ["中行", "中国银行"]),
    ("建设银行", ["建行", "建设银行"]),
    ("邮储银行", ["邮储", "邮政储蓄", "邮储银行", "邮储信用卡"]),
    ("招商银行", ["招行", "招商银行", "招商"]),
    ("中信银行", ["中信银行", "中信"]),
    ("光大银行", ["光大银行", "光大"]),
    ("华夏银行", ["华夏银行", "华夏"]),
    ("民生银行", ["民生银行", "民生"]),
    ("广发银行", ["广发", "广发银行", "废行"]),
    ("平安银行", ["平安银行", "平安口袋", "平安"]),
    ("兴业银行", ["兴业银行", "兴业"]),
    ("浦发银行", ["浦发", "浦发银行"]),
    ("北京银行", ["北京银行", "掌上京彩"]),
    ("交通银行", ["交行", "交通银行"]),
    ("盛京银行", ["盛京", "盛京银行"]),
    ("南京银行", ["南京银行"]),
    ("上海银行", ["上海银行"]),
    ("汇丰银行", ["汇丰", "汇丰银行"]),
    ("宁波银行", ["宁波银行"]),
    ("天津银行", ["天津银行"]),
    ("浙商银行", ["浙商银行", "浙商"]),
    ("恒丰银行", ["恒丰", "恒丰银行"]),
    ("富邦华一", ["富邦华一"]),
    ("渣打银行", ["渣打", "渣打银行"]),
]
HEADING_BANKS = [
    "农业银行", "工商银行", "建设银行", "招商银行", "中国银行", "交通银行",
    "浦发银行", "中信银行", "光大银行", "民生银行", "华夏银行", "兴业银行", "广发银行",
    "平安银行", "邮储银行", "北京银行", "上海银行", "南京银行", "宁波银行",
    "江苏银行", "杭州银行", "秦农银行", "农商银行", "徽商银行", "浙商银行",
    "渤海银行", "恒丰银行",
    "农行", "工行", "建行", "招行", "中行", "交行",
    "浦发", "中信", "光大", "民生", "华夏", "兴业", "广发", "平安", "邮储",
]
ANNOUNCEMENT_BANKS = [
    "农行", "工行", "建行", "招行", "中行", "交行", "浦发", "中信", "光大", "民生", "华夏",
    "兴业", "广发", "平安", "邮储", "北京银行", "上海银行", "南京银行", "宁波银行",
    "江苏银行", "杭州银行", "秦农银行", "农商银行", "徽商银行", "浙商银行",
    "渤海银行", "恒丰银行", "银行",
]
HINT_BANKS = [
    "农业银行", "农行", "招商银行", "招行", "中信银行", "中信",
    "建设银行", "建行", "工商银行", "工行", "中国银行", "中行",
    "交通银行", "交行", "邮储银行", "邮储", "民生银行", "民生",
    "光大银行", "光大", "浦发银行", "浦发", "平安银行", "平安",
    "兴业银行", "广发银行", "广发", "华夏银行", "北京银行",
]
STRICT_DATE_SOURCES = [
    "邮政储蓄银行", "兴业银行", "广发银行", "华夏银行", "东亚银行",
    "宁波银行", "中国银行", "平安银行", "汇丰银行",
]

# ---- fixed values: cleaning ---------------------------------------------------
INTRO_OPENERS = ["说在前头", "自从公众号推送机制", "大行白金卡权益一缩再缩", "经典小神卡迎来反转", "好在还有这些可以选择"]
HIGHLIGHT_PREFIXES = [
    "尊敬的客户：", "尊敬的持卡人：", "附件：", "点击可查阅：",
    "一、活动时间", "二、活动对象", "三、活动内容", "四、活动细则",
]
DETAIL_LINE_PREFIXES = ["- 银行：", "- 卡种：", "- 卡面级别：", "- 卡面主题：", "- 活动：", "- 合作："]
DETAIL_NUMBERED = ["发卡银行", "卡种名称", "卡片级别", "卡面特色", "上线状态", "年费信息", "权益亮点"]
CARD_SUFFIXES = ["重磅上市", "正式发行", "燃情首发", "震撼来袭", "火热上线", "盛大发布", "即将上线", "全新上线", "新卡上线", "！", "!"]
CARD_MIDDLES = ["新卡上线", "重磅上市", "正式发行", "燃情首发"]
CARD_PREFIXES = ["狂欢", "重磅", "全新", "盛大", "火热", "震撼"]
AD_TEXTS = ["（以上内容为广告）", "以上内容为广告", ""]
AD_DISCLAIMERS = ["以上内容为广告", "本文为广告", "此内容为广告", "以上为广告"]
HEADER_MARKERS = ["您的位置：", "您的位置:", "当前位置：", "首页 >", "客服 >", "最新公告"]
FOOTER_MARKERS = ["网站地图", "隐私保密声明", "客户投诉渠道", "免责声明", "Copyright(C)"]
LATE_FOOTER_MARKERS = ["热门频道", "积分规则", "在线客服", "发现精彩APP", "信用卡官方APP", "广发银行版权所有", "网站声明"]
BODY_NOISE = [
    "ATM/自助/网点查询", "境外拨打服务热线", "特别卡种热点问题", "高端信用卡",
    "CarCard汽车信用卡", "常用文件下载", "个人税收居民身份声明", "无限卡授权委托书下载",
    "白金卡授权委托书下载", "附赠保险申请书下载", "失卡保障申请书下载", "银行首页",
    "广发卡招聘", "帮助中心", "无障碍辅助浏览", "投诉建议", "网银登录", "热门关键字",
    "热门频道", "积分规则", "在线客服", "发现精彩APP", "信用卡官方APP", "广发银行版权所有",
    "粤ICP备", "粤公网安备", "网站声明",
]
BODY_NOISE_LINES = [
    "|", "搜索", "首页", "分期", "公告", "优惠活动", "分期理财", "服务指南", "品牌历史",
    "当前位置：", "当前位置:", "【", "】", "字号：", "大", "中", "小", "< 返回", ">",
    "信用卡申请", "卡片申请", "消费者权益保护", "自助服务", "积分查询", "品牌历程",
]
BODY_START_MARKERS = ["尊敬的客户：", "尊敬的持卡人：", "为更好地", "为保障您的权益", "现将", "特此公告"]
PAGE_NAV_WORDS = [
    "首页", "登录", "注册", "办卡", "用卡", "查账", "还款", "账单查询",
    "客户服务", "信用卡申请", "激活", "设置", "积分", "权益", "活动",
    "分期", "增值", "年费", "保险", "联系我们", "网站地图", "English",
    "最新公告", "公告详情", "返回列表", "返回", "更多",
]
PAGE_START = r"^(尊敬|您好|各位|关于|我行|我司|因|为|自[0-9]|一、|1[.、])"
NAV_WORDS_5 = [
    "加入收藏", "在线申请信用卡", "产品介绍", "白金卡系列", "标准卡系列", "主题卡系列",
    "联名", "办卡须知", "收费标准", "用卡指南", "安全提醒", "全面客户服务",
]
NAV_WORDS_4 = [
    "加入收藏", "在线申请信用卡", "产品介绍", "白金卡系列", "标准卡系列",
    "主题卡系列", "联名", "办卡须知", "收费标准", "用卡指南", "全面客户服务",
]
BAD_TITLE_WORDS = ["活动时间", "活动规则", "参与方式", "活动详情", "活动对象", "活动简介", "活动内容", "活动主题"]
LOW_VALUE_NOTICE = [
    "数据库维护", "数据库升级", "数据库迁移", "数据库切换", "数据库优化", "数据库割接",
    "系统升级", "系统维护", "系统优化", "系统切换", "系统更新",
    "系统改造", "系统调整", "系统暂停", "系统变更", "系统下线",
    "客服电话变更", "客服热线变更", "服务热线变更", "电话变更",
    "电话号码更新", "联系电话变更", "24小时客服热线",
    "联系方式变更", "联系地址变更", "办公地址变更",
    "联系地址变更公告", "办公地址搬迁",
    "暂停服务", "服务暂停", "临时暂停", "暂停办理",
    "官网维护", "网站升级", "网站维护", "网页维护",
    "网络调整", "线路调整", "线路维护", "网络维护",
    "网络升级", "网络割接",
    "电话更新", "维护公告", "升级公告",
]
LOW_VALUE_DIGEST = ["首绑赠", "立减券", "洗车券", "首单立减", "卡号订制", "满30返", "满200返", "达标礼"]
SKIP_DETAIL_FIELDS = ["活动内容", "详情", "变更内容", "时间", "影响范围", "适用人群", "年费回报评估", "注意事项", "核心理由", "卡种", "来源"]

# ---- fixed values: fields -----------------------------------------------------
FIELD_ALIASES = {
    "亮点": "卡亮点", "卡亮点": "卡亮点",
    "生效日期": "时间", "时间": "时间", "发布时间": "时间", "活动时间": "时间",
    "原文链接": "原文链接", "来源": "来源", "来源链接": "来源",
    "详情": "详情", "卡种": "卡种", "适用人群": "适用人群",
    "影响范围": "影响范围", "变更内容": "变更内容", "点评": "点评",
    "消息内容": "消息", "消息": "消息", "结论": "结论", "亮点摘要": "卡亮点",
}
REPORT_ALIASES = {
    "亮点": "卡亮点", "卡亮点": "卡亮点",
    "生效日期": "时间", "活动时间": "时间", "时间": "时间",
    "原文链接": "原文链接", "来源": "来源", "来源链接": "来源",
    "详情": "详情", "适用人群": "适用人群",
    "影响范围": "影响范围", "变更内容": "变更内容",
    "点评": "点评", "消息内容": "消息", "消息": "消息", "卡种": "卡种",
}
LINK_FIELDS = ["原文链接", "原文链接：", "原文链接:", "来源", "来源链接", "source", "source_url"]
DEFAULT_AUDIENCE = "信用卡持卡人"
EXPECTED_FIELDS = {
    "新卡": ["卡种", "卡亮点", "适用人群", "来源", "详情"],
    "活动": ["活动内容", "活动时间", "适用人群"],
    "权益变更": ["消息时间", "影响范围", "变更内容", "变更分析"],
    "公告": ["消息内容", "点评"],
    "其他": ["详细内容"],
}
ACTION_WORDS_BY_CATEGORY = {
    "新卡": ["发布", "发行", "推出", "首发", "上市", "全新", "新卡"],
    "权益变更": ["调整", "变更", "升级", "取消", "优化", "缩水", "新规", "权益", "修改", "下架", "停用", "上线", "启用"],
    "活动": ["活动", "优惠", "返现", "满减", "立减", "福利", "折扣", "积分", "送", "消费奖励", "免年费", "达标", "新户",
           "里程", "开卡礼", "刷卡金", "兑换", "抽奖"],
}
ACTIVITY_BOILERPLATE = [
    "一、活动时间", "二、活动对象", "三、活动内容", "四、活动细则",
    "一、活动对象", "二、活动内容", "三、活动时间",
    "活动时间", "活动对象", "活动内容", "活动细则", "活动规则",
    "活动详情", "活动简介", "活动主题", "报名时间", "消费达标时间",
    "二、活动", "三、", "四、", "五、",
]
SENTENCE_MARKERS = [
    "活动时间", "活动内容", "活动对象", "报名时间", "领奖用奖时间",
    "消费达标时间", "活动规则", "活动详情", "活动细则", "活动期限",
    "优惠内容", "权益内容", "调整内容", "原规则", "新规则",
]
OCR_EMPTY_VALUES = ["未提及", "未说明", "未明确显示", "无", ""]

TIME_PATTERNS = [
    r"(\d{4}年\d{1,2}月\d{1,2}日(?:至|起|开始|生效)?(?:\d{4}年\d{1,2}月\d{1,2}日)?)",
    r"(\d{4}[./-]\d{1,2}[./-]\d{1,2}(?:至|起|开始|生效)?(?:\d{4}[./-]\d{1,2}[./-]\d{1,2})?)",
    r"(\d{1,2}月\d{1,2}日(?:至|起|开始|生效)?\d{1,2}月\d{1,2}日)",
]
SCOPE_PATTERNS = [
    r"(所有[^，。；\n]{2,30}持卡人)",
    r"([^，。；\n]{2,30}持卡人)",
    r"([^，。；\n]{2,30}(?:白金卡|金卡|普卡|信用卡|主卡|附属卡|卡客户|客户))",
]
# the first place where each of them can end, with the least that must stand before it
SCOPE_ENDS = ["金卡", "普卡", "信用卡", "主卡", "附属卡", "客户"]
SCOPE_CORES = [r"所有[^，。；\n]{2,30}持卡人", r"[^，。；\n]{2}持卡人", r"[^，。；\n]{2}(?:白金卡|金卡|普卡|信用卡|主卡|附属卡|卡客户|客户)"]
CHANGE_PATTERNS = [
    r"([^。；]{0,30}由[^。；]{1,30}调整为[^。；]{1,40})",
    r"([^。；]{0,30}从[^。；]{1,30}调整为[^。；]{1,40})",
    r"([^。；]{0,30}调整为[^。；]{1,40})",
    r"([^。；]{0,30}(?:取消|新增|下调|上调|优化|升级|缩减|变更)[^。；]{1,40})",
]
# what each of them must contain behind its opening
CHANGE_CORES = [r"由[^。；]{1,30}调整为[^。；]", r"从[^。；]{1,30}调整为[^。；]", r"调整为[^。；]", r"(?:取消|新增|下调|上调|优化|升级|缩减|变更)[^。；]"]
ACTIVITY_PATTERNS = [
    r"((?:满|消费满)[^。；]{1,30}(?:减|返|立减|赠|抽|免|享)[^。；]{1,30})",
    r"((?:可享|即有机会享受|有机会享受)[^。；]{1,40})",
    r"((?:刷卡|支付|报名|兑换)[^。；]{1,40})",
]
FEE_PATTERNS = [
    r"(首年[^，。；]{1,20}免[^，。；]{0,20})",
    r"(年费[^，。；]{1,30})",
    r"((?:刷卡|消费)[^，。；]{1,20}免年费)",
    r"(刚性年费[^，。；]{1,20})",
]

# ---- fixed values: scoring ----------------------------------------------------
CARD_PLUS = ["免年费", "返现", "积分", "接送机", "贵宾厅", "里程"]
CARD_PREMIUM = ["刚性年费", "高端", "白金", "钻石"]
CARD_MINUS = ["缩水", "停发", "限制"]
PROMO_VALUE = ["返现", "满减", "立减", "免费", "多倍积分"]
PROMO_RISK = ["名额有限", "限量", "先到先得"]
CHANGE_DOWN = ["缩水", "取消", "减少", "限制", "涨价", "下调"]
CHANGE_UP = ["升级", "新增", "增加", "放宽", "延长"]
TREND_WORDS = ["缩水", "取消", "减少", "限制", "下调", "降低"]
SCENES = ["返现", "里程", "贵宾厅", "接送机", "积分"]
DIMENSIONS = {
    "新卡": [("年费成本", 0.25), ("权益价值", 0.30), ("日常实用性", 0.20), ("门槛与独家性", 0.15), ("市场同类对比", 0.10)],
    "权益变更": [("权益变化方向", 0.35), ("持有成本变化", 0.25), ("影响范围", 0.20), ("替代方案", 0.20)],
    "活动": [("返利力度", 0.30), ("参与门槛", 0.25), ("时间充裕度", 0.20), ("日常匹配度", 0.15), ("叠加可能性", 0.10)],
    "公告": [("信息重要性", 0.40), ("行动紧迫性", 0.30), ("影响持久性", 0.30)],
}

# ---- fixed values: quality ----------------------------------------------------
CRITICAL_FLAGS = ["needs_category_review", "needs_source_review", "needs_overall_review"]
FINDING_KINDS = ["A", "B", "C", "D", "E"]
FINDING_PRIORITY = {"C": 0, "A": 1, "D": 2, "E": 3, "B": 4}
EXTERNAL_DOC_WORDS = ["公众号", "产品说明", "用户手册", "销售", "客户", "对外", "宣传", "推广"]
INTERNAL_DOC_WORDS = ["详设", "接口", "架构", "标书", "测试报告", "技术方案"]

# ---- fixed values: segmentation -----------------------------------------------
TEMPLATE_GROUPS = [
    ["活动时间", "活动对象", "活动内容"],
    ["卡种", "权益", "亮点", "年费", "适用人群"],
    ["活动时间", "活动内容", "适用人群", "参与方式"],
    ["优惠内容", "适用门店", "有效期"],
]
TOPIC_ACTIONS = ["首发", "新增", "调整", "返现", "积分", "优惠", "满减", "立减", "折扣", "免年费"]
NUMBERED_PREFIX = (
    r"^[一二三四五六七八九十]+[、.．]"
    r"|^\d+[、.．]"
    r"|^[\(（]\d+[\)）]"
    r"|^(?:活动|卡种|方案|权益|优惠)[一二三四五六七八九十]"
    r"|^(?:活动|卡种|方案|权益|优惠)\d+"
)
HINT_CARD = ["新卡", "首发", "发行", "上市", "卡种", "年费"]
HINT_PROMO = ["活动", "优惠", "返现", "积分", "满减"]
HINT_CHANGE = ["调整", "变更", "更新", "权益"]
HINT_NOTICE = ["公告", "通知", "关于", "提示"]
BOUNDARY_ACTIONS = [
    "下架", "上架", "新卡上线", "新卡", "上线", "发行", "调整", "变更", "取消",
    "权益", "活动", "发布", "新增", "返现", "积分", "升级", "首发", "退市", "下线",
    "公告", "通知", "缩水", "优化", "温暖",
]
BOUNDARY_HEADINGS = [
    "新卡上线", "新卡发行", "活动上线", "权益调整",
    "积分调整", "积分活动", "返现活动", "优惠活动",
    "下架提醒", "卡片下线", "公告通知",
]
BOUNDARY_STOPS = ["活动时间", "活动内容", "活动对象", "适用人群", "参与方式", "年费：", "权益：", "活动说明", "优惠内容"]
RAW_SPLIT_CONFIDENCE = 0.75
CTA_WORDS = ["扫码", "申请", "下载", "点击", "立即", "开通", "办理"]
IMAGE_NOISE_WORDS = ["图片为", "图（", "picture", "插画", "背景图", "示意图"]
FACT_TYPES = ["article_text", "ocr_fact"]

# ---- fixed values: digest documents -------------------------------------------
MD_SKIP_TITLES = ["总结", "目录", "参考资料"]
THEMES = [
    ("积分与权益", "积分|福气值|权益|年费|贵宾厅|免年费", "积分规则和持卡权益正在成为主要变化点"),
    ("AI 与联名产品", "AI|算力|Kimi|Qoder|智能体", "银行把 AI 会员或算力包装进信用卡权益"),
    ("年轻化产品", "MBTI|DIY|主题|贴纸|茶咖", "卡面、社交表达和年轻消费场景成为获客抓手"),
    ("短期营销活动", "活动|满[0-9]+|随机|名额|消费达标", "短期活动普遍依赖指定卡、名额或消费门槛"),
]
OVERVIEW_THEMES = [
    ("has_ai", "(?i)AI|Kimi|Qoder|算力|智能体", "AI联名观察"),
    ("has_points", "积分|福气值|年费|权益", "积分权益调整"),
    ("has_young", "(?i)MBTI|DIY|贴纸|茶咖", "年轻化产品"),
]
LABEL_STYLES = [
    ("亮点", "✨ 亮点", True),
    ("原文链接", "🔗 原帖", False),
    ("定位", "🎯 定位", False),
    ("活动内容", "📋 活动内容", True),
    ("适用人群", "👥 适用人群", False),
    ("详情", "📝 详情", True),
    ("时间", "📅 时间", False),
    ("影响范围", "🌐 影响范围", False),
    ("变更内容", "🔄 变更内容", True),
    ("卡种", "💳 卡种", False),
    ("来源", "📨 来源", False),
    ("年费回报评估", "💰 年费回报评估", False),
    ("是否值得申请", "✅ 是否值得申请", True),
    ("是否值得", "✅ 是否值得", True),
    ("核心理由", "💡 核心理由", False),
    ("注意事项", "⚠️ 注意事项", True),
]
LOW_VALUE_LIST = [
    "客服电话变更", "客服热线变更", "服务热线变更", "电话变更",
    "电话号码更新", "联系电话变更", "24小时客服热线",
    "联系客服", "客服热线", "客服电话", "联系方式",
    "联系地址变更", "办公地址变更", "办公地址搬迁", "联系地址",
    "暂停服务公告", "临时暂停服务",
    "暂停服务", "服务暂停", "临时暂停", "暂停办理",
]

# ---- fixed values: field labels, days in texts, names of cards and activities ------
FIELD_NAMES = [
    "活动内容", "活动时间", "适用人群", "卡种", "卡亮点", "详情", "来源", "消息时间", "影响范围", "变更内容", "变更分析", "消息内容", "点评",
    "卡组织", "发卡银行", "年费标准", "有效期限", "原文链接", "发布时间", "作者", "银行", "标题", "关键信息",
]
DAY_PATTERNS = [
    r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})",
    r"(\d{4})年(\d{1,2})月(\d{1,2})日?",
    r"(\d{4})\.(\d{1,2})\.(\d{1,2})",
    r"(?:news[_-])?(\d{2})(\d{2})(\d{2})\.(?:shtml|html)(?:$|[?#])",
]
CARD_BRANDS = ["Visa", "MasterCard", "银联", "JCB", "美国运通"]
BRANDED_CARD = r"(?:Visa|MasterCard|银联|JCB|美国运通)[^\s，。]{0,6}(?:卡|版)"
PLAIN_CARD = r"[^\s，。]{4,10}(?:卡|版)"
CARD_ENDS = ["卡", "版"]
NAMED_ACTIVITY = r"[^\s，。]{2,6}(?:活动|优惠|返现|赠)"
ACTIVITY_ENDS = ["活动", "优惠", "返现", "赠"]
ACTIVITY_END_CHARS = "活动优惠返现赠"
NOT_CARD_NAMES = ["扫码申卡", "主题信用卡", "信用卡", "银行卡", "借记卡"]
NOT_IN_CARD_NAMES = ["扫码", "主题"]
